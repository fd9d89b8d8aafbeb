"""Sessions of a stream against the same rule over tables."""

import datetime
import glob
import os
import random
import shutil

import pytest

from lodestone.streaming import sessions as S
from lodestone.streaming.upsert import arriving

SCHEMA = "user string, ts timestamp"
START = datetime.datetime(2024, 1, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def rows_of(df):
    return sorted((r.user, r.start, r.end, r.events) for r in df.collect())


class Feed:
    def __init__(self, spark, base):
        self.spark, self.base = spark, str(base)

    def run(self):
        stream = arriving(self.spark, f"{self.base}/in", self.spark.createDataFrame([], SCHEMA).schema, 1000)
        S.session_stream(stream, f"{self.base}/out", f"{self.base}/state", ["user"], "ts", "10 minutes", "30 minutes")

    def arrive(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{self.base}/in")
        self.run()

    def closed(self):
        return S.closed(self.spark, f"{self.base}/out", "user string")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_sessions_close_behind_the_watermark(feed):
    feed.arrive([("a", at(0)), ("a", at(9)), ("a", at(20)), ("b", at(0))])
    assert rows_of(feed.closed()) == []
    feed.arrive([("b", at(50))])  # the watermark is 20: b's session ended at 10, a's first at 19, a's second at 30
    assert rows_of(feed.closed()) == [("a", at(0), at(19), 2), ("b", at(0), at(10), 1)]
    feed.arrive([("a", at(9)), ("a", at(10)), ("a", at(11)), ("a", at(25))])  # the first two end at 19 and 20
    feed.arrive([("c", at(500))])
    assert rows_of(feed.closed()) == [("a", at(0), at(19), 2), ("a", at(11), at(35), 3), ("b", at(0), at(10), 1), ("b", at(50), at(60), 1)]


def test_a_batch_that_is_done_again_changes_nothing(feed):
    feed.arrive([("a", at(k)) for k in range(0, 100, 7)] + [("b", at(k)) for k in range(0, 100, 13)])
    feed.arrive([("a", at(200))])
    before = rows_of(feed.closed())
    assert before
    last = max(glob.glob(f"{feed.base}/state/commits/*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    checksum = f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc"
    if os.path.exists(checksum):
        os.remove(checksum)
    number = os.path.basename(last)
    shutil.rmtree(f"{feed.base}/out/batch={number}", ignore_errors=True)
    feed.run()
    assert rows_of(feed.closed()) == before
    feed.run()
    assert rows_of(feed.closed()) == before


def test_stream_and_tables_agree(spark, feed):
    rng = random.Random(5)
    events = [(rng.choice("abcdef"), at(rng.randrange(0, 2000) + rng.random())) for _ in range(700)]
    delayed, arrived = events[:60], events[60:]
    ordered = sorted(arrived, key=lambda r: r[1])
    for k in range(3):
        feed.arrive(ordered[k * 220 : (k + 1) * 220])
    feed.arrive(delayed)
    feed.arrive([("z", at(1_000_000))])
    first, second = (spark.createDataFrame(r, SCHEMA) for r in (arrived, delayed))
    expected = S.with_late_arrivals(first, second, ["user"], "ts", "10 minutes", "30 minutes")
    assert rows_of(feed.closed()) == rows_of(expected)
    late = S.late(first, second, "ts", "10 minutes", "30 minutes").count()
    assert 0 < late < 60 and expected.agg({"events": "sum"}).first()[0] == 700 - late


def test_tables_of_no_or_null_times(spark):
    rows = spark.createDataFrame([("a", None), (None, at(0)), (None, at(10)), (None, at(19))], SCHEMA)
    assert sorted((r.start, r.events) for r in S.sessions(rows, ["user"], "ts", "10 minutes").collect()) == [(at(0), 3)]
    nothing = rows.limit(0)
    assert S.with_late_arrivals(nothing, nothing, ["user"], "ts", "10 minutes", "30 minutes").count() == 0
