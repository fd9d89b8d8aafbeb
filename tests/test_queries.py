"""Each query of the engine's own operators against its SQL in DuckDB, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from lodestone.plans import disclosures, exchange, pipeline, relational, reports, texts
from lodestone.streaming import queries as streams

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = {}, {}
for module in (relational, disclosures, texts, reports, exchange, pipeline, streams):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for name in os.listdir(FOLDER):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    answer = duck.sql(ORACLES[name])
    assert sorted(answer.columns) == columns
    at = [answer.columns.index(c) for c in columns]
    expected = Counter(tuple(plain(r[k]) for k in at) for r in answer.fetchall())
    assert got == expected
    assert expected, "nothing to compare"


def test_long_pages_equal_sql(spark, tmp_path):
    paragraphs = "".join(f"<p>t{n}</p>" for n in range(1, 1200))
    pages = [(7, paragraphs), (8, "<p>a<p>\xa0<p>b<p> &nbsp;\xa0<p>c<p>d\xa0 e"), (-7, "<p>a<p>b"), (9, None), (10, "")]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = {tuple(r[c] for c in ("page_id", "number", "title", "text")) for r in reports.html_segments(spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == set(c.sql(f"SELECT page_id, number, title, text FROM ({ORACLES['html_segments']})").fetchall())
    assert (7, "1197-8", "Title of 1197", "t1197") in got and (8, "3-9", "Title of 3", "c") in got and (-7, "1--6", "Title of 1", "a2") in got


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1


def test_the_rest_does_not_import_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(f"{root}/lodestone"):
        if os.sep + "llm" in folder:
            continue
        for n in names:
            if n.endswith(".py"):
                with open(f"{folder}/{n}", encoding="utf-8") as f:
                    assert "lodestone.llm" not in f.read(), n
