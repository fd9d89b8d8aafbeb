import random

import numpy as np
from pyspark.sql import functions as F

from lodestone.llm import quality as Q


def table(spark, n=300):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinsh") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], []
    for k in range(n):
        words = [word() for _ in range(rng.randrange(20, 90))]
        good = k % 4 != 0
        text = " ".join(words) + "." if good else rng.choice([" | ".join(words), "!! ".join(w.upper() for w in words), " ".join([words[0]] * 60), "%%% ".join(words)])
        rows.append((k, text))
        labels.append((k, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = table(spark)
    model = Q.fit(docs, labels.where("doc_id % 3 <> 1"))
    got = {r.doc_id: r.score for r in Q.score(docs, model).collect()}
    held = [(got[r.doc_id] >= 0.5) == bool(r.quality) for r in labels.where("doc_id % 3 = 1").collect()]
    assert np.mean(held) > 0.95 and all(0 <= s <= 1 for s in got.values())


def test_order_of_rows_does_not_matter(spark):
    docs, labels = table(spark, 80)
    a = Q.fit(docs, labels)
    b = Q.fit(docs.orderBy(F.rand(1)).repartition(5), labels.repartition(3))
    assert np.allclose(a.weights, b.weights, atol=1e-5)


def test_ranking_prefers_and_cuts_at_the_quantile():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(0, 1, (300, 5)), rng.normal(2.5, 1, (300, 5))])
    better = np.arange(600) >= 300
    model = Q.rank(rows, better, 0.5)
    raw = model.raw(rows)
    assert (raw[better][:, None] > raw[~better][None, :]).mean() > 0.99
    assert abs((model.scores(rows) >= 0.5).mean() - 0.5) < 0.02


def test_every_labelled_row_counts(spark):
    """Many more rows than were once drawn: the loss over all pairs is at its least, and the threshold is the quantile of all scores."""
    rng = np.random.default_rng(3)
    rows = rng.normal(0, 1, (6000, 4))
    better = rows @ np.array([1, -1, 0.5, 0]) + rng.normal(0, 1, 6000) > -1
    model = Q.rank(rows, better, float(better.mean()))
    unit = np.clip((rows - model.mean) / model.scale, -8, 8)
    s = unit @ model.weights
    lean = 1 / (1 + np.exp(s[better][:, None] - s[~better][None]))
    slope = -(lean.mean(axis=1) @ unit[better]) / better.sum() + (lean.mean(axis=0) @ unit[~better]) / (~better).sum() + Q.DECAY * model.weights
    assert np.abs(slope).max() < 2e-3
    assert (model.scores(rows) >= 0.5).sum() == better.sum()
    # 500 copies of each text: none may be left out of what is learned
    docs, labels = table(spark, 40)
    copies = spark.range(500).select((F.col("id") * 1000).alias("_k"))
    many = [d.join(copies).withColumn("doc_id", F.col("doc_id") + F.col("_k")).drop("_k") for d in (docs.withColumn("text", F.concat("text", F.lit(" end"))), labels)]
    few = Q.fit(docs.withColumn("text", F.concat("text", F.lit(" end"))), labels)
    assert np.allclose(few.weights, Q.fit(*many).weights, atol=1e-4) and np.allclose(few.mean, Q.fit(*many).mean)


def test_features_of_a_text_do_not_depend_on_others():
    texts = ["A b c.", "", "x x x x", "\n\n", "Ünï 12 !!"]
    together = Q.features(texts)
    for k, t in enumerate(texts):
        assert np.allclose(together[k], Q.features([t])[0])
    assert not together[1].any()
    assert np.isclose(together[0, : Q.TRIGRAMS].sum(), 1)


def test_odd_labels_and_empty_tables(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (10**9, 1), (3, 7)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    assert {r.score for r in Q.score(docs, model).collect()} == {0.5}
    assert Q.score(nothing, model).count() == 0
    assert {r.score for r in Q.score(docs, Q.fit(nothing, labels.limit(0))).collect()} == {0.5}
