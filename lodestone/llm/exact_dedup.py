"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import in_arrow, text_slices
from lodestone.sources.tables import table

#: Columns that stand beside a caller's own for a while.
OWN = tuple(f"__exact_dedup_{c}" for c in ("sha", "salt", "content", "nth"))
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """Groups of rows whose texts are equal once white space is normalised.

    Rows meet in three stages, each of which groups by the full content, never by a digest
    alone: within a map partition (the aggregate before the first exchange), within a salt of
    the digest, and over the salts. A group that holds a third of all rows reaches a task as one
    row for each map partition of its salt, then as one row for each salt. What a group is called
    goes back to its rows salt by salt as well.

    Returns a row for each input row: the id, keep_id (the smallest id of the group), group_size,
    kept and text_sha256 (of the normalised text). Null text counts as empty. Ids that are null
    come last in a group. Where an id repeats with the same text, one of the rows is kept.
    Columns besides the id and the text are not read.
    """
    of_id = lambda c: F.pmod(F.xxhash64(c), F.lit(salts))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE_SPACE, " ").alias("_norm"),
        of_id(id_col).alias("_salt"),
    ).withColumn("_sha", F.unhex(F.sha2("_norm", 256)))
    salted = rows.groupBy("_sha", "_salt", "_norm").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    groups = salted.groupBy("_sha", "_norm").agg(F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"))
    # contents were told apart in full; that the digest names just one of them is checked, not assumed
    named = groups.groupBy("_sha").agg(F.min("_keep").alias("_keep"), F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_contents"))
    size = F.when(F.col("_contents") == 1, F.col("_n")).otherwise(F.raise_error(F.lit("two contents have one SHA-256")).cast("long"))
    # a row of a group of one is in its own id's salt; others may be in any
    every = F.when(F.col("_n") == 1, F.array(of_id("_keep"))).otherwise(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))
    named = named.select(F.col("_sha").alias("_named"), "_keep", size.alias("_n"), F.explode(every).alias("_of"))
    # equal ids are in one salt, so that the join's exchange serves this window as well
    repeat = F.row_number().over(Window.partitionBy("_sha", "_salt", "_id").orderBy(F.lit(1)))
    members = rows.select("_id", "_sha", "_salt").join(named, (F.col("_sha") == F.col("_named")) & (F.col("_salt") == F.col("_of"))).withColumn("_repeat", repeat)
    return members.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_repeat") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def locally(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows without those that an equal text of a smaller id beats in the same batch of a map task."""
    of_id, of_text = docs.columns.index(id_col), docs.columns.index(text_col)
    white = re.compile(WHITE_SPACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[str, int] = {}
            ids = batch.column(of_id).to_pylist()
            for first, texts in text_slices(batch.column(of_text)):
                for k, text in enumerate(texts, first):
                    held = best.setdefault(white.sub(" ", text), k)
                    if ids[k] is not None and (ids[held] is None or ids[k] < ids[held]):
                        best[white.sub(" ", text)] = k
            yield batch.take(pa.array(sorted(best.values()), pa.int64()))

    return in_arrow(docs, run, docs.schema)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows that stay: of equal texts the one with the smallest id, with all its columns.

    The same three stages as ``exact_dedup``, of whole rows, so that none needs to be joined back:
    within a batch of a map task, within a salt of the digest, over the salts. The normalised
    text is what decides; it is made anew behind each exchange and doesn't cross it. Null ids come
    last; of rows that repeat an id and a text, one stays.
    """
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE_SPACE, " ")
    sha, salt, content, nth = OWN
    rows = locally(docs, id_col, text_col).withColumn(sha, F.sha2(norm, 256)).withColumn(salt, F.pmod(F.xxhash64(id_col), F.lit(salts)))
    for keys in ([sha, salt], [sha]):
        first = F.row_number().over(Window.partitionBy(*keys, content).orderBy(F.col(id_col).asc_nulls_last(), text_col))
        rows = rows.repartition(*keys).withColumn(content, norm).withColumn(nth, first).where(F.col(nth) == 1).drop(content, nth)
    return rows.select(*docs.columns)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equals, their number and the digest; as of ``exact_dedup``."""
    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, norm FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
