import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestone.llm import ngram_join as J
from lodestone.llm.components import components


def shingle_set(text, n=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, threshold=0.8, words=5):
    """doc_id -> (class_id, n_links), for distinct ids."""
    sets = {k: shingle_set(t, words) for k, t in rows}
    up, links = {k: k for k in sets}, Counter()

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: (root(k), links[k]) for k in keys}


def test_matches_brute_force(docs, documents):
    got = J.ngram_join(docs)
    assert got.columns == ["doc_id", "class_id", "n_links"]
    expected = brute(documents)
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == expected
    assert sum(n > 0 for _, n in expected.values()) > 20


@pytest.mark.parametrize(("words", "threshold"), [(5, 0.5), (3, 0.65), (2, 0.9)])
def test_other_shingles_and_thresholds(docs, documents, words, threshold):
    got = J.ngram_join(docs, words=words, threshold=threshold)
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == brute(documents, threshold, words)


def test_bands_follow_the_threshold():
    assert [J.band_rows(t) for t in (0.5, 0.7, 0.8, 0.9)] == [2, 3, 4, 6] and J.band_rows(0.05) == 1
    assert all((1 - t ** J.band_rows(t)) ** (J.HASHES // J.band_rows(t)) <= J.MISSED for t in (0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95))


def test_query_on_a_table(spark, documents, tmp_path):
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = J.op2_ngram_join(spark, str(tmp_path))
    assert got.columns == ["doc_id", "class_id", "n_links"]
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == brute(documents)


def test_texts_of_repeated_patterns_are_told_apart(spark):
    a = "a"
    for _ in range(10):
        a += a.translate({97: 98, 98: 97})
    b = a.translate({97: 98, 98: 97})
    rows = [(1, a), (2, b), (3, f"{a} {b}"), (4, f"{b} {a}")]
    assert {r.doc_id: (r.class_id, r.n_links) for r in J.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {k: (k, 0) for k in (1, 2, 3, 4)}


@pytest.mark.parametrize(("block", "items"), [(8, 1_000_000), (2048, 1000)])
def test_large_bucket_meets_in_blocks(spark, monkeypatch, block, items):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "BLOCK_ITEMS", items)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(base[:k] + ["odd"] + base[k:])) for k in range(0, 120, 2)] + [(1000 + k, " ".join(base)) for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {r.doc_id: (r.class_id, r.n_links) for r in J.ngram_join(df).collect()} == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long), (1, long), (1, long + " more"), (None, long), (2, None), (2, ""), (3, "a b"), (4, "A, b!"), (None, None)]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in J.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(1, 1, 3): 3, (None, 1, 3): 1, (2, 2, 0): 2, (3, 3, 1): 1, (4, 3, 1): 1, (None, None, 0): 1})


def test_pruning_keeps_what_reaches_the_threshold():
    rng = np.random.default_rng(4)
    least = J.least_matches(0.8)
    assert [n for n, _ in least] == list(range(16, 129, 16)) and all(m <= 0.8 * n for n, m in least)
    lost = 0
    for _ in range(4000):
        hits = np.cumsum(rng.random(128) < 0.8)
        lost += any(hits[n - 1] < m for n, m in least)
    assert lost == 0
    assert all(any((rng.random(128) < 0.3).cumsum()[n - 1] < m for n, m in least) for _ in range(200))


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    x, y = J.minhashes([np.sort(a), np.sort(b)])
    assert abs((x == y).mean() - 800 / 1200) < 0.15


def test_one_of_each_class_stays(docs, documents):
    out = J.keep_one_of_class(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for c, _ in brute(documents).values()})


def test_empty(nothing):
    assert J.ngram_join(nothing).count() == 0
    assert J.keep_one_of_class(nothing).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (7, 3), (9, 8)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 60)] + [(99, 98), (98, 60), (60, 59)]])
def test_components(spark, edges):
    up = {k: k for e in edges for k in e}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    groups = defaultdict(set)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    for r in got:
        groups[r.root].add(r.node)
    assert {r.node: r.root for r in got} == {k: root(k) for k in up}


def test_null_and_repeated_ids_bring_no_other_texts(spark):
    """A third of the rows without an id: each candidate is joined to its own text alone."""
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(6)) for _ in range(60))
    base = [text() for _ in range(40)]
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t) for k, t in enumerate(base)] + [(None if k % 2 else 7, t + " and more") for k, t in enumerate(base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.ngram_join(df).collect()
    assert len(got) == 80 and all(r.n_links == 1 for r in got)
    joined = []
    real = J.met

    def met(candidates, words, threshold):
        joined.append(candidates.count())
        return real(candidates, words, threshold)

    J.met = met
    try:
        assert J.ngram_join(df).count() == 80
    finally:
        J.met = real
    assert joined == [80]
