"""Tables for charts: a row for each scored credit, and for each numeric measurement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.sizes import sent_if_small
from lodestone.functions import fixed as X
from lodestone.functions import values as V
from lodestone.operators.joins import comparable, keep


def first_rule(rules: Sequence[tuple[Column, str]]) -> Column:
    """The text of the first rule that holds, else null."""
    out = F.lit(None).cast("string")
    for test, text in reversed(rules):
        out = F.when(test, text).otherwise(out)
    return out


def scores(master: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """A row for each anchored credit, so that a sum of scores is the real total.

    keys: institution, institution_key; a small table.
    """
    rows = master.where("anchor").withColumn("score", F.col("score").try_cast("double")).withColumn("max", F.col("max").try_cast("double"))
    rows = rows.withColumn("pct_of_max", V.percentage(F.col("score"), F.col("max")))
    return rows if keys is None else rows.join(sent_if_small(keys), "institution", "left").withColumn("institution_key", F.coalesce("institution_key", F.lit("")))


def strongest_links(mapping: DataFrame) -> DataFrame:
    """Of a field's confirmed answers the strongest, ties by line: (credit, field) -> standard, disclosure, relationship."""
    used = mapping.where((F.col("review_status") == "confirmed") & F.col("relationship").isin(*X.ANSWERS))
    rows = used.withColumn("credit", F.trim("credit")).withColumn("field", F.trim("field"))
    return keep(rows, ["credit", "field"], [V.position(F.col("relationship"), X.RELATIONSHIPS), F.col("line")]).select("credit", "field", "standard", "disclosure", "relationship")


def metrics(master: DataFrame, mapping: DataFrame, n_institutions: int, bookkeeping: str = "Points earned", notes: Sequence[tuple[Column, str]] = ()) -> DataFrame:
    """A row for each numeric measurement with the disclosure it answers, if any.

    is_intensity: its name states a ratio. comparable: all institutions report it. data_quality: the
    first known reason why its figure can't be read at face value, else null.
    """
    rows = master.where((F.col("value_type") == "number") & F.col("value_numeric").isNotNull() & ~F.startswith("field", F.lit(bookkeeping)))
    rows = rows.join(strongest_links(mapping), ["credit", "field"], "left")
    rows = rows.withColumn("mapped", F.col("disclosure").isNotNull()).withColumn("is_intensity", F.coalesce(F.col("field").rlike(X.INTENSITY), F.lit(False)))
    return comparable(rows, ["credit", "field"], "institution", n_institutions).withColumn("data_quality", first_rule(notes))


def review_worksheet(mapping: DataFrame, records: DataFrame) -> DataFrame:
    """Each mapping row with the values that institutions give for its field, in a stated order."""
    given = records.groupBy("credit", "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("institution", "value"))), lambda r: F.concat_ws(": ", r["institution"], r["value"])), "; ").alias("values"))
    return mapping.join(given, ["credit", "field"], "left").withColumn("values", F.coalesce("values", F.lit("")))
