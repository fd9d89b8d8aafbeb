"""Incremental ingest: files that arrive are merged into a table by key, each once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.operators.joins import keep


def arriving(spark: SparkSession, path: str, schema: StructType, per_batch: int = 1000) -> DataFrame:
    """A stream of the Parquet files that a folder gets."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def upsert_stream(stream: DataFrame, target: str, keys: Sequence[str], order: str, checkpoint: str) -> None:
    """Merge what has arrived into a table of versions at ``target``, and stop.

    A batch writes only its own last row of each key, as a version numbered by the batch, so a batch
    that is done again after a failure replaces itself. ``current`` reads the winners. The cost
    of a batch is that of the batch, not of the table.
    """

    def write(batch: DataFrame, number: int) -> None:
        last = keep(batch, keys, [F.col(order).desc()])
        last.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def current(spark: SparkSession, target: str, keys: Sequence[str], order: str) -> DataFrame:
    """The last version of each key: of the latest batch that has it."""
    return keep(spark.read.parquet(target), keys, [F.col("batch").desc(), F.col(order).desc()]).drop("batch")


def compact(spark: SparkSession, target: str, into: str, keys: Sequence[str], order: str) -> None:
    """A new table of versions with the winners alone, as batch -1."""
    current(spark, target, keys, order).write.mode("errorifexists").parquet(f"{into}/batch=-1")
