import math
import re
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import lm_score as M


def brute(rows, order, seen=2, backoff=0.4):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[k - n : k]) for w in lists for n in range(1, order + 1) for k in range(n, len(w) + 1))
    total = sum(map(len, lists))
    out = []
    for (key, _), words in zip(rows, lists, strict=True):
        log = 0.0
        for k in range(1, len(words) + 1):
            for n in range(min(order, k), 0, -1):
                gram = tuple(words[k - n : k])
                if n == 1:
                    log += math.log(counts[gram] / total)
                elif counts[gram] >= seen:
                    log += math.log(counts[gram] / counts[gram[:-1]])
                    break
                else:
                    log += math.log(backoff)
        out.append((key, len(words), pytest.approx(log, abs=1e-6)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_matches_brute_force(docs, documents, order, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_CHARS", 20_000)
    monkeypatch.setattr(M, "PART_GRAMS", 2_000)
    got = sorted((r.doc_id, r.n_words, r.log_score) for r in M.lm_scores(docs, order=order).collect())
    assert got == brute(documents, order)


def test_counts_of_many_chunks_are_added_up_level_by_level(docs, documents, monkeypatch):
    monkeypatch.setattr(M, "CHUNK_CHARS", 15_000)
    monkeypatch.setattr(M, "PART_GRAMS", 3_000)
    monkeypatch.setattr(M, "FAN", 3)
    got = sorted((r.doc_id, r.n_words, r.log_score) for r in M.lm_scores(docs).collect())
    assert got == brute(documents, 3)


def test_words_of_repeated_patterns_are_told_apart(spark):
    text = "a"
    for _ in range(10):
        text += text.translate({97: 98, 98: 97})
    rows = [(1, text), (2, text.translate({97: 98, 98: 97})), (3, text)]
    got = sorted((r.doc_id, r.n_words, r.log_score) for r in M.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows, 3)


def test_repeated_rows_nulls_and_empty(spark, nothing):
    rows = [(1, "a b a b"), (1, "a b a b"), (None, "b a"), (2, None), (3, " \n")]
    got = M.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.log_score) for r in got) == sorted((str(k), n, s) for k, n, s in brute(rows, 3))
    assert {r.mean_log_score for r in got if not r.n_words} == {None}
    assert M.lm_scores(nothing).count() == 0


def test_packing_keeps_hashes_and_counts():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        own = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (M.unpacked(M.packed(own)) == own).all()
        rows = M.sent(own, np.arange(len(own), dtype=np.uint64), 7, 3)
        assert set(rows.column("_of").to_pylist()) <= {7} and rows.column("_part").to_pylist() == sorted({int(x) >> 61 for x in own})
        if n:
            _, back, counts = M.added_up(rows)
            assert (back == own).all() and counts.tolist() == list(range(len(own)))


def test_query_matches_brute_force(spark, documents, tmp_path):
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op8_lm_score(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "log_score", "mean_log_score"]
    expected = {k: (n, log.expected) for k, n, log in brute(documents, 3)}
    for r in got.collect():
        n, log = expected.pop(r.doc_id)
        assert r.n_words == n and r.log_score == pytest.approx(log, abs=1e-3) and r.mean_log_score == (pytest.approx(log / n, abs=1e-3) if n else None)
    assert not expected
