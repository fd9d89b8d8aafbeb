import math
import random

import numpy as np
import pytest

from lodestone.operators import search as S
from lodestone.operators import vectors as W

SCHEMA = "item_id long, vector array<double>, lane string"


def cosine(a, b):
    n = max(len(a), len(b))
    a, b = a + [0.0] * (n - len(a)), b + [0.0] * (n - len(b))
    dot = sum(x * y for x, y in zip(a, b, strict=True))
    return round(dot / max(math.hypot(*a) or 1e-12, 1e-12) / max(math.hypot(*b) or 1e-12, 1e-12), 6) + 0.0


@pytest.fixture(scope="module")
def items():
    """(item_id, vector, lane): few different small vectors, so that many tie; odd ones among them."""
    rng = random.Random(4)
    rows = [(k, [float(rng.randrange(-2, 3)) for _ in range(4)], rng.choice(["a", "b", "c"])) for k in range(300)]
    rows += [(300, None, "a"), (301, [None, 1.0, 1.0, 1.0], "b"), (302, [float("nan")] * 4, "a"), (303, [], "c"), (304, [1.0], "a"), (305, [0.0] * 4, "b"), (7, [1.0, 1.0, 1.0, 1.0], "b"), (306, [1.0, 0.0, 0.0, 0.0], None)]
    return rows


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(items, ids, k, apart=True, least=None, lane=None):
    out = set()
    for q, a, _ in items:
        if q in ids and good(a):
            hits = [(-cosine(a, v), i, g) for i, v, g in items if good(v) and not (apart and i == q)]
            hits = sorted((h for h in hits if least is None or -h[0] >= least), key=lambda h: h[:2])
            if lane:
                first = (k + 1) // 2
                hits = sorted((h for g in {h[2] for h in hits} for h in [x for x in hits if x[2] == g][: first if g == lane else k - first]), key=lambda h: h[:2])
            out |= {(q, i, -s, n, *([g] if lane else [])) for n, (s, i, g) in enumerate(hits if lane else hits[:k], 1)}
    return out


@pytest.mark.parametrize("at_once", [(1000, 1000), (40, 1000), (1000, 2), (37, 3)])
def test_blocks_change_nothing(spark, items, monkeypatch, at_once):
    df = spark.createDataFrame(items, SCHEMA)
    ids = set(range(0, 300, 20)) | {303, 304, 305, 302}
    queries = df.where(df.item_id.isin(*ids)).selectExpr("item_id AS query_id", "vector AS query")
    monkeypatch.setattr(S, "SCORES_AT_ONCE", 500)
    run = lambda **more: S.best_in_blocks(queries, df, 5, digits=6, at_once=at_once, **more)
    ranked = lambda rows: {(r.query_id, r.item_id, r.score, r["rank"]) for r in rows.collect()}
    assert ranked(W.top_k(run(apart=True), ["query_id"], 5, "item_id")) == expected(items, ids, 5)
    assert ranked(W.top_k(run(min_score=0.5), ["query_id"], 5, "item_id")) == expected(items, ids, 5, False, 0.5)
    found = S.best_in_blocks(queries, df, 2, {"a": 3}, True, digits=6, at_once=at_once)
    assert {(r.query_id, r.item_id, r.score, r["rank"], r.lane) for r in W.lane_quota(found, 5, "a").collect()} == expected(items, ids, 5, lane="a")


def test_only_the_best_leave_a_block(spark, items):
    """As many rows as queries, blocks and places allow, and no join of pairs in the plan."""
    df = spark.createDataFrame(items, SCHEMA)
    queries = df.where("item_id % 20 = 0").selectExpr("item_id AS query_id", "vector AS query")
    found = S.best_in_blocks(queries, df, 3, at_once=(100, 10))
    blocks = math.ceil(len(items) / 100)
    assert found.count() <= queries.count() * blocks * 3
    plan = found._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_ids_of_other_kinds_and_nothing(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), (None, [0.0, 1.0])], "item_id string, vector array<float>")
    queries = spark.createDataFrame([("a", [1.0, 0.0])], "query_id string, query array<float>")
    got = W.nearest(queries, items, 5).collect()
    assert [(r.item_id, round(r.score, 4), r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [("b", 0.7071, 1), (None, 0.0, 2)]
    numbers = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query array<float>")
    assert W.nearest(numbers, items, 1).first().item_id == "a"
    assert W.nearest(queries.limit(0), items, 5).count() == 0 and W.nearest(queries, items.limit(0), 5).count() == 0
    with_lane = items.selectExpr("*", "'x' AS lane")
    assert W.nearest_by_lane(queries, with_lane.limit(0), 5, "x").count() == 0


def test_ties_beyond_k():
    scores = np.array([[0.5, 0.9, 0.5, 0.5], [-np.inf, -np.inf, 0.1, -np.inf]])
    row, column = S.best_of_rows(scores, 2, np.array([3, 2, 1, 0]))
    assert list(zip(row.tolist(), column.tolist(), strict=True)) == [(0, 1), (0, 3), (1, 2)]


def test_texts_are_dealt_out_once(spark, tmp_path):
    """Terms are counted, weighed and brought to length 1 where their texts are; texts cross one exchange, counts none."""
    from lodestone.operators import vectors as W

    docs = spark.createDataFrame([(1, "solar wind power solar"), (2, "wind power grid"), (2, "grid grid"), (3, None)], "id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    counts = W.term_counts(docs, "id", "text")
    assert {(r.id, r.term): r.tf for r in counts.collect()} == {(1, "solar"): 2, (1, "wind"): 1, (1, "power"): 1, (2, "wind"): 1, (2, "power"): 1, (2, "grid"): 3}
    frequencies = spark.createDataFrame([("wind", 2, 1.0), ("grid", 2, 2.0)], "term string, df long, idf double")
    weighed = W.weights(counts, frequencies, "id")
    plan = weighed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r.id, r.term): r.w for r in weighed.collect()}
    assert got[1, "wind"] == 1 and abs(got[2, "wind"] ** 2 + got[2, "grid"] ** 2 - 1) < 1e-12 and len(got) == 3
