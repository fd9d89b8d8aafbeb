"""Many numbers by a trie find what a pattern of them finds."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import references as R

NUMBERS = ["305-1", "305-10", "403-10", "403-1", "2-9", "305", "a.1", "a.1b", "3"]
PARTS = [
    "GRI ", "gri\t", "Disclosure ", "Disclosures  ", "xGRI ", "éGRI ", "Scope ", "scopes ", "Scope", " and ", ", ", " , and ", "&", " & ", ",", " to ", "and", "305-1", "305-10", "305-11", "305", "305-1x", "403-1", "2-9", "2-90", "3",
    "A.1", "a.1B", "a.1bc", "1", "2", "3", "1,5", "2.5", "4", "x", "é", "_", " ", ".", "\n", "12,345.6.",
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(6)
    rows = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 14))) for _ in range(4000)]
    rows += [rng.choice(["GRI ", "Scopes "]) + ", ".join(rng.choice(["305-1", "305", "2-9", "1", "2", "305-1x", "12x"]) for _ in range(rng.randrange(1, 8))) for _ in range(1500)]
    rows += ["", None, "GRI", "GRI 305-1", "İGRI 3", "GRI 3" + ", 3" * 3000 + "x"]
    return spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, t string").repartition(8).cache()


def test_equals_the_pattern(spark, texts):
    trie, pattern = R.References(spark, NUMBERS), T.reference_pattern(NUMBERS)
    context = F.array(F.col("t"), F.reverse("t"))
    of = lambda r: texts.select("k", T.redact_figures(F.col("t"), r).alias("a"), T.numbers_in(F.col("t"), r).alias("b"), T.audit_digits(F.col("t"), F.array(F.substring("t", 1, 9)), context, r).alias("c"))
    short = texts.where("length(t) < 5000 or t is null")
    assert texts.count() - short.count() == 1
    got, expected = ({r.k: r for r in of(r).where("k <> 5505").collect()} for r in (trie, pattern))
    different = [(k, expected[k], got[k]) for k in expected if got[k] != expected[k]]
    assert not different, different[:3]
    assert sum("[figure]" not in (r.a or "") and any(c.isdigit() for c in r.a or "") for r in got.values()) > 100


def test_long_lists_are_walked_once():
    trie = R.Trie(NUMBERS)
    for tail, end in (("", None), ("x", -4)):
        text = "GRI 3" + ", 3" * 20_000 + tail
        (span,) = trie.spans(text)
        assert span == (0, len(text) if end is None else len(text) + end)
    assert trie.spans("GRI " * 5000) == []


def test_a_hundred_thousand_numbers(spark):
    numbers = [f"{k % 1000}-{k // 1000 + 1}" for k in range(100_000)]
    vocabulary = spark.createDataFrame([(n,) for n in numbers], "disclosure string")
    found = R.references_of(vocabulary)
    assert isinstance(found, R.References) and isinstance(R.references_of(vocabulary.limit(50)), str)
    rows = spark.range(2000).select(F.concat(F.lit("Of GRI "), (F.col("id") % 1000).cast("string"), F.lit("-100, 7-3 and 5-101 it is "), F.col("id").cast("string"), F.lit(" t.")).alias("t"), "id")
    begin = time.monotonic()
    got = rows.select("id", T.numbers_in(F.col("t"), found).alias("n"), T.redact_figures(F.col("t"), found).alias("r")).collect()
    assert time.monotonic() - begin < 60
    assert all(r.n == ["5", "101", str(r.id)] and r.r.endswith("-100, 7-3 and [figure]-[figure] it is [figure] t.") for r in got)
    with pytest.raises(ValueError, match="more than"):
        R.references_of(vocabulary, most=99_999)


def test_vocabularies_of_one_session_are_told_apart(spark):
    rows = spark.createDataFrame([("GRI 1-1, GRI 2-2 and GRI 3-3",)], "t string").repartition(1)
    for _ in range(2):
        for k in range(1, 8):
            found = R.References(spark, [f"{k}-{k}"])
            expected = [n for j in (1, 2, 3) if j != k for n in (str(j), str(j))]
            assert rows.select(T.numbers_in(F.col("t"), found)).first()[0] == expected
