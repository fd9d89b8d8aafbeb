"""Sessions by event time: a stream with a watermark and a state store, and the same rule over tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F


def session_stream(events: DataFrame, target: str, checkpoint: str, keys: Sequence[str], time: str, gap: str, delay: str) -> None:
    """Close what has become closed of the sessions of a stream's events, and stop: (keys, start, end, events) at ``target``.

    A session is a run of a key's events no more than ``gap`` apart; it ends ``gap`` after its last event. The watermark is
    the latest event time less ``delay``; what ends at or before it is written, once, and leaves the state store; an event whose own
    session would end there comes too late and is dropped (``late`` finds those). A batch writes a folder of its own number,
    so one that is done again after a failure replaces itself.
    """
    by = F.session_window(F.col(time), gap)
    sessions = events.withWatermark(time, delay).groupBy(*keys, by.alias("_session")).agg(F.count(F.lit(1)).alias("events"))
    rows = sessions.select(*keys, F.col("_session.start").alias("start"), F.col("_session.end").alias("end"), "events")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def closed(spark: SparkSession, target: str, keys_and_kinds: str) -> DataFrame:
    """The sessions that a stream has closed; ``keys_and_kinds`` is the schema of its keys."""
    return spark.read.schema(f"{keys_and_kinds}, start timestamp, end timestamp, events long, batch int").parquet(target).drop("batch")


def sessions(events: DataFrame, keys: Sequence[str], time: str, gap: str) -> DataFrame:
    """(keys, start, end, events): the sessions of a table's events. Null times belong to none."""
    before = F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    new = F.coalesce(F.col(time) > before + F.expr(f"INTERVAL {gap}"), F.lit(True))
    numbered = events.where(F.col(time).isNotNull()).withColumn("_n", F.sum(F.when(new, 1).otherwise(0)).over(Window.partitionBy(*keys).orderBy(time)))
    found = numbered.groupBy(*keys, "_n").agg(F.min(time).alias("start"), (F.max(time) + F.expr(f"INTERVAL {gap}")).alias("end"), F.count(F.lit(1)).alias("events"))
    return found.drop("_n")


def watermark(events: DataFrame, time: str, delay: str) -> DataFrame:
    """(watermark): what a stream's is after these events, to the millisecond, as a stream keeps it."""
    return events.agg((F.date_trunc("millisecond", F.max(time)) - F.expr(f"INTERVAL {delay}")).alias("watermark"))


def late(arrived: DataFrame, events: DataFrame, time: str, gap: str, delay: str) -> DataFrame:
    """Those of ``events`` that come too late after what has ``arrived``: their own sessions would end at or before the watermark."""
    mark = F.broadcast(watermark(arrived, time, delay))
    return events.join(mark, F.col(time) + F.expr(f"INTERVAL {gap}") <= F.col("watermark"), "left_semi")


def with_late_arrivals(arrived: DataFrame, delayed: DataFrame, keys: Sequence[str], time: str, gap: str, delay: str) -> DataFrame:
    """The sessions of events that arrived in time and of others that came after the watermark had passed: the stream's rule, over tables.

    What was closed stays as it was; what was open takes up the delayed events that aren't too late.
    """
    mark = F.broadcast(watermark(arrived, time, delay))
    of = lambda rows: sessions(rows, keys, time, gap)
    first = of(arrived)
    done = first.join(mark, F.col("end") <= F.col("watermark"), "left_semi")
    open_ = first.join(mark, F.col("end") > F.col("watermark"), "left_semi")
    span = [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys] + [F.col(f"e.{time}") >= F.col("s.start"), F.col(f"e.{time}") < F.col("s.end")]
    kept = arrived.alias("e").join(open_.alias("s"), span, "left_semi")
    taken = delayed.join(mark, F.col(time) + F.expr(f"INTERVAL {gap}") > F.col("watermark"), "left_semi")
    return done.unionByName(of(kept.select(*keys, time).unionByName(taken.select(*keys, time))))
