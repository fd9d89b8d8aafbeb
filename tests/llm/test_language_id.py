import random

import numpy as np
from pyspark.sql import functions as F

from lodestone.llm import language_id as L

SYLLABLES = {"aa": ["the", "ing", "tion", "er", "an"], "bb": ["eau", "ré", "ment", "è", "ou"], "cc": ["sch", "keit", "ung", "ü", "ein"]}


def table(spark, n=240):
    rng = random.Random(3)
    rows = []
    for k in range(n):
        lang = ("aa", "bb", "cc")[k % 3]
        rows.append((k, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 80))), lang))
    rows += [(n, None, "aa"), (n + 1, "", "bb"), (n + 2, "123 !?", "cc"), (n + 3, "keit ung", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_undetermined(spark):
    df = table(spark)
    model = L.fit(df.where("doc_id % 4 <> 0"))
    got = {r.doc_id: r for r in L.predict(df, model).collect()}
    assert model.languages == ["aa", "bb", "cc"]
    right = [got[r.doc_id].lang_pred == r.lang for r in df.where("doc_id % 4 = 0 and doc_id < 240").collect()]
    assert np.mean(right) == 1
    assert [got[k].lang_pred for k in (240, 241, 242)] == ["und"] * 3
    assert [got[k].score for k in (240, 241, 242)] == [0.0] * 3
    assert all(0 <= r.score <= 1 for r in got.values())


def brute_features(text):
    text = "".join(c if c.isalpha() else " " for c in text.lower())
    out = []
    for n in L.ORDERS:
        out.append([text[k : k + n] for k in range(len(text) - n + 1) if text[k : k + n].strip()])
    return out


def test_features_are_the_grams_of_each_text_alone():
    texts = ["Ab c", "", "x", "  ", "Éa, b"]
    found, starts, letters = L.features(texts)
    for k, t in enumerate(texts):
        for order, index in zip(brute_features(t), found, strict=True):
            end = starts[k + 1] if k + 1 < len(texts) else starts[k] + len(t) + 1
            assert (index[starts[k] : end] < L.BUCKETS).sum() == len(order)
    assert letters.tolist() == [3, 0, 1, 0, 3]
    alone = [np.sort(i[i < L.BUCKETS]) for i in L.features(["Éa, b"])[0]]
    together = [np.sort(i[starts[4] :][i[starts[4] :] < L.BUCKETS]) for i in found]
    assert all((a == b).all() for a, b in zip(alone, together, strict=True))


def test_posterior_by_hand():
    model = L.LanguageModel(["p", "q"], np.log([0.25, 0.75]), np.zeros((2, L.BUCKETS + 1)))
    scores, _ = model.scores(["anything", ""])
    assert np.allclose(np.exp(scores), [[0.25, 0.75]] * 2)


def test_bounded_sample_is_about_the_bound(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.lit("l").alias("lang"))
    full, part = L.fit(df), L.fit(df, rows_per_language=300)
    assert full.languages == part.languages == ["l"]


def test_no_labels_and_no_rows(spark, nothing, docs):
    df = table(spark).withColumn("lang", F.lit(None).cast("string"))
    got = L.predict(df, L.fit(df))
    assert {r.lang_pred for r in got.collect()} == {"und"}
    model = L.fit(table(spark))
    assert L.predict(nothing, model).count() == 0
    assert L.predict(docs, model).count() == docs.count()
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns
    gone = {r.text for r in docs.collect()} - {r.text for r in kept.collect()}
    # one letter alone leaves all three languages below one half
    assert gone == {None, "", " ", "12 34 !!", "x"}
