import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import periodic_runs as R
from lodestone.llm import registry


def brute(words, least=24, periods=3):
    """All runs by comparing every pair of words of every distance."""
    out, n = [], len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, periods * q) and not any(q % d == 0 and words[i : j + q - d] == words[i + d : j + q] for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    drop = {k for a, length, q in runs for k in range(a + q, a + length)}
    kept = " ".join(w for k, w in enumerate(words) if k not in drop)
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *four, sha("".join(f"{a},{length},{q}\n" for a, length, q in runs)), sha(kept))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(2, 8))
def test_runs_of_small_alphabets(word, least):
    """All runs of length and periods as small as can be, where nothing hides a wrong extension."""
    got = R.runs_of(np.array(word), least=least, periods=2)
    assert [tuple(r) for r in got.tolist()] == brute(word, least, 2)


def test_runs_of_nested_and_long_ones():
    rng = random.Random(2)
    for _ in range(150):
        text = []
        while len(text) < 300:
            part = [rng.randrange(3) for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 9)
            text += part * rng.choice((1, 1, 4))
        assert [tuple(r) for r in R.runs_of(np.array(text)).tolist()] == brute(text)
    fib = [1], [1, 0]
    for _ in range(12):
        fib = fib[1], fib[1] + fib[0]
    assert [tuple(r) for r in R.runs_of(np.array(fib[1])).tolist()] == brute(fib[1])


def test_stretches_lose_no_run():
    """Pieces that recur: with the filter the runs of whole texts are the same."""
    rng = random.Random(3)
    lists = []
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(6)):
            if rng.random() < 0.5:
                words += [str(rng.randrange(50)) for _ in range(rng.randrange(60))]
            else:
                q = rng.randrange(1, 40)
                root = [str(rng.randrange(1 + q)) for _ in range(q)]
                words += (root * 12)[: rng.randrange(20, 5 * q + 30)]
        lists.append(words)
    lists += [[], ["a"] * 24, ["a"] * 23, ["a"] * 7, (["a", "b"] * 20)[:25]]
    for words, runs in zip(lists, R.texts_runs(lists), strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute(words)


def test_range_minima():
    rng = np.random.default_rng(1)
    for n in (1, 5, 16, 17, 400):
        values = rng.integers(0, 1000, n)
        low, high = np.sort(rng.integers(0, n, (2, 500)), axis=0)
        assert R.LowestBetween(values)(low, high).tolist() == [values[a : b + 1].min() for a, b in zip(low, high, strict=True)]


@pytest.fixture(scope="module")
def rows(documents):
    rng = random.Random(8)
    out = list(documents)
    ids = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 10 == 0][:40]
    out += [(k, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 400)))) for k in ids]
    out += [(ids[0], ""), (ids[1], None), (ids[2], "one"), (ids[3], " \x0b\n"), (ids[3], " \x0b\n"), (None, "x " * 40), (None, None)]
    out += [(5000, "a b\tc\nd " * 9 + "a b c"), (5001, "é\xa0ü " * 30), (5002, "p q r s t u v w " * 3), (5003, "x y " * 15 + "z " + "x y " * 15)]
    return out


def test_registered_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS source", "1 AS n_runs", "2 AS _words", "3 AS _g").write.parquet(f"{tmp_path}/documents.parquet")
    df = registry.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 6 + ["string"] * 2
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(((k, *expected(k, t)) for k, t in rows), key=key)


def test_texts_come_back(spark, docs, documents, nothing):
    got = {r.doc_id: r for r in R.periodic_runs(docs).collect()}
    assert len(got) == len(documents)
    long = next(k for k, t in documents if t and t.startswith("ab ab"))
    assert got[long].runs == "0,900,1\n" and got[long].collapsed == "ab" and got[long].exponent_milli == 900_000
    assert R.periodic_runs(nothing).count() == 0


def test_a_long_text():
    words = [str(k % 5000) for k in range(30_000)] + ["x"] + ["a", "b", "a"] * 20_000
    (runs,) = R.texts_runs([words])
    assert [tuple(r) for r in runs.tolist()] == [(0, 30_000, 5000), (30_001, 60_000, 3)]
