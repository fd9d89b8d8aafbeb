"""Joins and merges: outer joins that say where a row came from, upserts, amendments, integrity."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.nulls import is_blank, is_populated, row_key


def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The columns of a list that are there, in its order."""
    return df.select(*[n for n in names if n in df.columns])


def uniform(frames: Sequence[DataFrame], fill: str = "") -> DataFrame:
    """The union of like records, columns that one lacks filled; all with the same shape."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.fillna(fill)


def outer_with_origin(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """A full outer join whose rows say whether they have details and which of a key's rows is its anchor.

    has_left and has_detail tell the sides a row came from; anchor is true for the first row
    of each key of the left side by ``order``, so that what the left side states once is counted
    once. Columns that both sides have, keys aside, are the left side's. Keys that are null never
    meet.
    """
    right = right.drop(*[c for c in right.columns if c in left.columns and c not in keys])
    joined = left.withColumn("has_left", F.lit(True)).join(right.withColumn("has_detail", F.lit(True)), list(keys), "full_outer")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("has_left"), *order))
    return (
        joined.withColumn("has_left", F.coalesce("has_left", F.lit(False)))
        .withColumn("has_detail", F.coalesce("has_detail", F.lit(False)))
        .withColumn("anchor", F.col("has_left") & (nth == 1))
    )


def keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by a total order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def comparable(df: DataFrame, keys: Sequence[str], member: str, n: int) -> DataFrame:
    """The rows with ``comparable``: whether a key's group has ``n`` different members, nulls aside."""
    known = df.where(F.col(member).isNotNull()).groupBy(*keys).agg((F.countDistinct(member) == n).alias("comparable"))
    return df.join(known, list(keys), "left").withColumn("comparable", F.coalesce("comparable", F.lit(False)))


def upsert(base: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Rows by key, those of the batch winning; within a side the last by ``order`` wins."""
    both = base.withColumn("_side", F.lit(0)).unionByName(batch.withColumn("_side", F.lit(1)))
    return keep(both, keys, [F.col("_side").desc(), *order]).drop("_side")


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row states, by trimmed parts, with the number of rows."""
    return rows.groupBy(row_key(*keys).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def amend(base: DataFrame, changes: DataFrame, inserts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The base with changes to its rows and rows that it lacks, and what became of each in ``outcome``.

    A change states new values; null leaves the old one. Outcomes: kept, applied, already (the
    values were there), missing (no such row; the change is listed with its values), inserted.
    Applying the same again changes nothing. Keys compare by trimmed parts.
    """
    values = [c for c in base.columns if c not in keys]
    old = base.withColumn("_key", row_key(*keys))
    new = changes.select(row_key(*keys).alias("_key"), F.lit(True).alias("_stated"), *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in values if c in changes.columns])
    joined = old.withColumn("_there", F.lit(True)).join(new, "_key", "full_outer")
    stated = [c for c in values if c in changes.columns]
    differs = F.lit(False)
    for c in stated:
        differs = differs | (F.col(f"_new_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_new_{c}")))
    outcome = F.when(F.col("_there").isNull(), "missing").when(F.col("_stated").isNull(), "kept").when(differs, "applied").otherwise("already")
    merged = joined.select(
        "_key", *[F.coalesce(k, f"_key_{k}").alias(k) for k in keys],
        *[(F.coalesce(f"_new_{c}", c) if c in stated else F.col(c)).alias(c) for c in values], outcome.alias("outcome"),
    )
    fresh = inserts.withColumn("_key", row_key(*keys)).join(old.select("_key"), "_key", "left_anti").withColumn("outcome", F.lit("inserted"))
    return merged.unionByName(fresh, allowMissingColumns=True).drop("_key")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key no parent has; rows without a key are none."""
    known = parents.select(F.col(parent_key).alias("_parent")).distinct()
    return rows.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_parent"), "left_anti")


def two_way_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: (key, side)."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def violations(mapping: DataFrame, vocabulary: DataFrame, records: DataFrame, relationships: Sequence[str], states: Sequence[str]) -> DataFrame:
    """(line, rule) for each rule that a row of a mapping breaks; a rule's row per break.

    mapping: line, credit, field, standard, disclosure, relationship, review_status, caveat.
    vocabulary: standard, disclosure. records: credit, field. Blank or ``*`` fields mean the
    whole credit.
    """
    m = mapping.select("line", *[F.trim(c).alias(c) for c in ("credit", "field", "standard", "disclosure", "relationship", "review_status", "caveat")])
    vocab = vocabulary.select(F.col("disclosure").alias("_d"), F.col("standard").alias("_s")).distinct()
    credits = records.select(F.col("credit").alias("_c")).where("_c is not null").distinct()
    fields = records.select(F.col("credit").alias("_fc"), F.coalesce("field", F.lit("*")).alias("_ff")).distinct()
    wants_disclosure = m.where(~F.col("relationship").eqNullSafe("gap_stars_side"))
    wants_credit = m.where(~F.col("relationship").eqNullSafe("gap_gri_side"))
    said = wants_disclosure.where(~is_blank("disclosure"))
    known = wants_credit.where(~is_blank("credit"))
    in_set = lambda c, values: F.coalesce(F.col(c).isin(*values), F.lit(False))
    rules = [
        ("unknown relationship", m.where(~in_set("relationship", relationships))),
        ("unknown review status", m.where(~in_set("review_status", states))),
        ("disclosure not allowed", m.where(F.col("relationship").eqNullSafe("gap_stars_side") & ~is_blank("disclosure"))),
        ("disclosure missing", wants_disclosure.where(is_blank("disclosure"))),
        ("disclosure unknown", said.join(vocab, F.col("disclosure") == F.col("_d"), "left_anti")),
        ("wrong standard", said.join(vocab, F.col("disclosure") == F.col("_d")).where(~F.col("standard").eqNullSafe(F.col("_s")))),
        ("credit not allowed", m.where(F.col("relationship").eqNullSafe("gap_gri_side") & ~is_blank("credit"))),
        ("credit missing", wants_credit.where(is_blank("credit"))),
        ("credit unknown", known.join(credits, F.col("credit") == F.col("_c"), "left_anti")),
        ("field unknown", known.join(credits, F.col("credit") == F.col("_c"), "left_semi").where(~is_blank("field")).join(fields, (F.col("credit") == F.col("_fc")) & (F.col("field") == F.col("_ff")), "left_anti")),
        ("warning: partial without caveat", m.where(F.col("relationship").eqNullSafe("partial") & is_blank("caveat"))),
    ]
    out = None
    for name, rows in rules:
        part = rows.select("line", F.lit(name).alias("rule"))
        out = part if out is None else out.unionByName(part)
    return out


def publishable(mapping: DataFrame, include_partial: bool = False) -> DataFrame:
    """Confirmed rows that answer a disclosure in full; with ``include_partial`` those that do in part, too.

    Then an uncaveated one among these is an error, whichever columns are used of the result.
    """
    rows = mapping.where((F.col("review_status") == "confirmed") & F.col("relationship").isin("equivalent", "component", "intensity", *["partial"] * include_partial))
    bad = (F.col("relationship") == "partial") & ~is_populated("caveat")
    return rows.where(F.when(bad, F.raise_error(F.lit("a partial mapping has no caveat")).cast("boolean")).otherwise(F.lit(True)))
