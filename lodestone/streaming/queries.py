"""Streaming queries on the driver's tables; an extension, for the engine's model is batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.stages import passing_folder, written
from lodestone.sources.tables import table
from lodestone.streaming.sessions import closed, late, session_stream, with_late_arrivals
from lodestone.streaming.upsert import arriving, current, upsert_stream


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Events that arrive in four batches of files: by user the last event of the last batch that has one."""
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    with passing_folder(spark, "stream_upsert") as base:
        for k in range(4):
            events.where(f"event_id % 4 = {k}").write.mode("append").parquet(f"{base}/in")
            # what has arrived is one batch, however many files it is
            upsert_stream(arriving(spark, f"{base}/in", events.schema, 1_000_000), f"{base}/out", ["user_id"], "event_id", f"{base}/state")
        return written(current(spark, f"{base}/out", ["user_id"], "event_id"))


GAP, DELAY = "20 hours", "3 days"


def timed(spark: SparkSession, d: str) -> DataFrame:
    """Events with a time, and whether each comes after all others."""
    return table(spark, d, "events").where("ts is not null").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 23 == 0).alias("delayed"))


def wall_clock(rows: DataFrame, *columns: str) -> DataFrame:
    """Times as the table has them, without a zone."""
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of users by event time, closed by a watermark, of events that arrive in four batches in order, and stragglers in a fifth.

    One event in 23 comes after all others: too late if its own session would have ended before the watermark, which is three days behind the
    latest event; else it joins what is still open. An event long after all of them closes the rest, and is in no session here.
    """
    events = timed(spark, d)
    edges = events.where("not delayed").agg(F.percentile_approx("ts", [0.25, 0.5, 0.75]).alias("q"), F.max("ts").alias("last")).first()
    with passing_folder(spark, "stream_sessions") as base:

        def arrive(rows: DataFrame) -> None:
            rows.select("user_id", "ts").write.mode("append").parquet(f"{base}/in")
            stream = arriving(spark, f"{base}/in", rows.select("user_id", "ts").schema, 1_000_000)
            session_stream(stream, f"{base}/out", f"{base}/state", ["user_id"], "ts", GAP, DELAY)

        bounds = [None, *edges["q"], None]
        for low, high in zip(bounds, bounds[1:], strict=False):
            part = events.where("not delayed")
            part = part if low is None else part.where(F.col("ts") > F.lit(low))
            arrive(part if high is None else part.where(F.col("ts") <= F.lit(high)))
        arrive(events.where("delayed"))
        arrive(spark.range(1).select(F.lit(None).cast("long").alias("user_id"), (F.lit(edges["last"]) + F.expr("INTERVAL 1000 days")).alias("ts")))
        return written(wall_clock(closed(spark, f"{base}/out", "user_id long").where("user_id is not null"), "start", "end"))


def batch_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The same sessions by the same rule over tables."""
    events = timed(spark, d)
    return wall_clock(with_late_arrivals(events.where("not delayed"), events.where("delayed"), ["user_id"], "ts", GAP, DELAY), "start", "end")


def late_events(spark: SparkSession, d: str) -> DataFrame:
    """The stragglers that come too late to be in any session."""
    events = timed(spark, d)
    return wall_clock(late(events.where("not delayed"), events.where("delayed"), "ts", GAP, DELAY), "ts").drop("delayed")


def _grouped(rows: str) -> str:
    return f"""SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '{GAP}' AS "end", count(*) AS events FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '{GAP}' THEN 0 ELSE 1 END AS fresh FROM {rows})) GROUP BY user_id, n"""


SESSIONS_SQL = f"""
WITH a AS (SELECT user_id, ts FROM events WHERE event_id % 23 <> 0), b AS (SELECT event_id, user_id, ts FROM events WHERE event_id % 23 = 0),
m AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '{DELAY}' AS mark FROM a), s AS ({_grouped("a")}),
k AS (SELECT user_id, ts FROM a SEMI JOIN (SELECT * FROM s WHERE "end" > (SELECT mark FROM m)) o ON a.user_id = o.user_id AND a.ts >= o.start AND a.ts < o."end"
  UNION ALL SELECT user_id, ts FROM b WHERE ts + INTERVAL '{GAP}' > (SELECT mark FROM m))
"""
SESSIONS_RESULT = f"""SELECT * FROM s WHERE "end" <= (SELECT mark FROM m) UNION ALL ({_grouped("k")})"""

QUERIES = {"stream_upsert": stream_upsert, "stream_sessions": stream_sessions, "batch_sessions": batch_sessions, "late_events": late_events}
ORACLES = {
    "stream_sessions": SESSIONS_SQL + SESSIONS_RESULT,
    "batch_sessions": SESSIONS_SQL + SESSIONS_RESULT,
    "late_events": SESSIONS_SQL + f"SELECT event_id, user_id, ts FROM b WHERE ts + INTERVAL '{GAP}' <= (SELECT mark FROM m)",
    "stream_upsert": "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 4 DESC, event_id DESC) = 1",
}
