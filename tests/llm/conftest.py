import random

import pytest
from pyspark.sql import functions as F

#: Names that operators use within, or return.
CLASHES = ["score", "_sha", "_norm", "_nth", "_salt", "_keep", "_key", "_n", "_sig", "_drop", "_bucket", "_pos", "_val", "_digest", "_start", "_chunk", "_words", "_lang", "_y", "piece", "length", "spans", "class_id", "n_links"]
LETTERS = "etaoinshrdlucmfwypvbgkqjxz"


def words(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text): unique texts, copies, near copies, odd and empty ones, a null, a long one."""
    rng = random.Random(11)
    texts = [words(rng, rng.randrange(8, 200)) for _ in range(60)]
    rows = list(texts)
    for t in texts[:8]:
        rows.append(t)
        w = t.split()
        for k in (1, 2, 3):
            near = list(w)
            near[rng.randrange(len(near))] = f"zz{k}"
            rows.append(" ".join(near))
    rows += [texts[9].replace(" ", "\t \n")] * 3
    shared = words(rng, 70)
    rows += [f"{words(rng, 60)} {shared} {words(rng, 50)}" for _ in range(3)]
    rows += ["", None, None, " ", "x", "one two three", "12 34 !!", "😀é ß ǅ İ", "a\x85b c\x1fd", words(rng, 9000), "z" * 5000, "ab " * 900]
    return list(enumerate(rows))


@pytest.fixture(scope="session")
def docs(spark, documents):
    """The same as a table with more columns than are asked for, some of names that clash."""
    df = spark.createDataFrame(documents, "doc_id long, text string")
    return df.select("doc_id", "text", F.lit("src0").alias("source"), F.lit("x").alias("_id"), F.lit(1).alias("_text"), *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)], F.lit(None).cast("string").alias("kept"))


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
