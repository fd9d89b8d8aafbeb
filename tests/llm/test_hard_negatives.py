import math
import random

import duckdb
import numpy as np
import pytest

from lodestone.llm import hard_negatives as H
from lodestone.llm import registry


def brute(rows, positives=5, negatives=10, band=(30, 90), every=100):
    """Rows (id, label, vector) in plain Python."""
    good = [(k, g, [math.floor(256 * x) for x in v]) for k, g, v in rows if None not in (k, g, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (k, g, v) in enumerate(good):
        if k % every:
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w, strict=False))  # noqa: E731, B023
        ranked = sorted((-score(w), j, h) for m, (j, h, w) in enumerate(good) if m != n)
        for s, j, _ in [r for r in ranked if r[2] == g][:positives]:
            hard = [r for r in ranked if r[2] != g and band[0] * -s <= 100 * -r[0] <= band[1] * -s][:negatives]
            out += [(k, j, rank, i, -s, -t) for rank, (t, i, _) in enumerate(hard, 1)]
    return sorted(out)


def made(n, dim, labels, seed, smooth=False, ids=None):
    rng = np.random.default_rng(seed)
    if smooth:  # components of a segment are alike, so that means say nearly all
        x = np.repeat(rng.normal(0, 0.3, (n, dim // 4 + 1)), 4, axis=1)[:, :dim] + rng.normal(0, 0.01, (n, dim))
    else:
        x = rng.normal(0, 0.3, (n, dim)) + rng.normal(0, 0.2, (labels, dim))[np.arange(n) % labels]
    return [(ids[k] if ids else k, int(rng.integers(labels)), [float(np.float32(c)) for c in row]) for k, row in enumerate(x)]


SCHEMA = "vec_id long, label int, embedding array<float>"


def mined(spark, rows, every=100, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, H.hard_negatives(df, df.vec_id % every == 0, **options).collect()))


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(H, "AT_ONCE", 64)


@pytest.mark.parametrize(("dim", "smooth"), [(1, False), (3, False), (10, True), (64, False), (64, True)])
def test_equals_brute_force(spark, dim, smooth):
    rows = made(700, dim, 3, dim, smooth)
    assert mined(spark, rows, every=20, block_bytes=100) == brute(rows, every=20)
    assert mined(spark, rows, every=100, positives=2, negatives=3, band=(10, 120)) == brute(rows, 2, 3, (10, 120))


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = made(300, 8, 4, 9)
    rows += [(100, 1, None), (200, None, [0.1] * 8), (None, 1, [0.1] * 8), (300, 1, [0.1] * 7 + [float("nan")]), (400, 1, [float("inf")] + [0.0] * 7), (500, 2, [None] + [0.1] * 7)]
    rows += rows[100:104] * 3 + [(k, g, v) for k, g, v in rows[200:201] * 2]  # repeated rows, an anchor among them
    rows += [(600, 1, [0.0] * 8), (601, 1, [0.0] * 8), (700, 3, []), (701, 3, [0.5]), (800, 99, [0.4] * 8), (-100, 0, [0.3] * 8)]
    rows += [(900 + k, k % 3, rows[5][2]) for k in range(200)]  # one vector with many copies
    rng.shuffle(rows)
    assert mined(spark, rows, block_bytes=100) == brute(rows)


def test_large_components_are_exact(spark):
    rows = [(k, g, [x * 1e5 for x in v]) for k, g, v in made(150, 4, 2, 4)]
    rows = [(k, g, [float(np.float32(x)) for x in v]) for k, g, v in rows]
    assert mined(spark, rows, every=10) == brute(rows, every=10)
    with pytest.raises(Exception, match="(?i)overflow|too large|long"):
        mined(spark, [(k, g, [1e30, 1.0]) for k, g, _ in rows])


def test_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, made(50, 4, 2, 1)[1:]) == []
    assert mined(spark, [(0, 1, [0.5])]) == []


def test_bounds_hold_and_prune():
    """No score is outside the bounds of any level; vectors whose segments are alike are mostly never scored."""
    for smooth in (False, True):
        rows = made(500, 64, 2, 5, smooth)
        x = np.floor(256 * np.array([v for _, _, v in rows]))
        ids = np.arange(len(rows))
        batch = H.packed(0, ids, ids, np.array([g for _, g, _ in rows]), ids % 10 == 0, x)
        own = H.Vectors.read(batch.to_pylist()[0])
        assert (own.vectors == x).all() and [m.shape[1] for m, _ in own.levels] == [1, 4, 16]
        exact, width = x @ x.T, math.inf
        for mean, rest in own.levels:
            centre, spread = mean @ mean.T, rest @ rest.T
            assert (np.abs(exact - centre) <= spread + 1e-5 * own.norm[:, None] * own.norm + 1).all()
            assert spread.mean() <= width + 1
            width = spread.mean()
        seen = [0, 0]

        def count(pairs, scored, seen=seen):
            seen[0] += pairs
            seen[1] += scored

        list(H.best_alike(own, own, 5, count))
        assert seen[1] <= seen[0] and (not smooth or seen[1] < 0.5 * seen[0])


def test_registered_query(spark, tmp_path):
    rows = [*made(450, 16, 10, 7), (450, None, [0.1] * 16), (451, 2, None), (452, 2, [None] * 16), (453, 2, [float("nan")] * 16)]
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _row", "'x' AS rank").write.parquet(f"{tmp_path}/embeddings.parquet")
    df = registry.QUERIES["op11_hard_negatives"](spark, str(tmp_path))
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    moved = [(k, g if k % 7 or g is None else (g + 1) % 10, v) for k, g, v in rows]
    got = sorted(map(tuple, df.collect()))
    assert got and got == brute(moved)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(duckdb.sql(registry.ORACLES["op11_hard_negatives"]).fetchall()) == got
