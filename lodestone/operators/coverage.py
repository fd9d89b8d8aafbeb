"""Which disclosures an institution can report, and from which fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.sizes import sent_if_small
from lodestone.functions import fixed as X
from lodestone.functions.nulls import is_populated
from lodestone.operators.joins import keep


def first_values(records: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first record of each key: repeated fields are read once."""
    return keep(records, keys, order)


def provenance(mapping: DataFrame, entities: DataFrame, records: DataFrame) -> DataFrame:
    """A row for each entity and usable mapping row whose field the entity has: populated or not.

    mapping: disclosure, credit, field, relationship, review_status. entities: entity. records:
    entity, credit, field, value; one row for each key.
    """
    used = mapping.where((F.col("review_status") == "confirmed") & F.col("relationship").isin(*X.ANSWERS))
    return used.join(records, ["credit", "field"]).join(entities, "entity", "left_semi").select("entity", "disclosure", "relationship", "credit", "field", "value", is_populated("value").alias("populated"))


def coverage(vocabulary: DataFrame, mapping: DataFrame, entities: DataFrame, records: DataFrame, proposed: str = "Not reported") -> DataFrame:
    """A row for each entity and disclosure: status, values_available and citable.

    Not assessed: no mapping row. Not reported: a confirmed gap, or none is confirmed and one
    rejected, or no mapped field is populated. ``proposed``: the status where all rows are
    proposed; chart tables take it as not reported, a content index as not assessed. Partially reported: all usable rows are partial.
    Reported otherwise. Citable: there is a strong relationship and a value; citable_strict: on the
    same row.
    The entities, as many as reporting institutions, are broadcast if a count finds them few.
    """
    per = mapping.groupBy("disclosure").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("review_status") == "confirmed").alias("_confirmed"),
        F.count_if(F.col("review_status") == "rejected").alias("_rejected"),
        F.count_if((F.col("review_status") == "confirmed") & (F.col("relationship") == "gap_gri_side")).alias("_gaps"),
        F.count_if((F.col("review_status") == "confirmed") & F.col("relationship").isin(*X.ANSWERS)).alias("_usable"),
        F.count_if((F.col("review_status") == "confirmed") & F.col("relationship").isin(*X.CITABLE)).alias("_strong"),
    )
    found = provenance(mapping, entities, records).where("populated").groupBy("entity", "disclosure").agg(F.count(F.lit(1)).alias("_values"), F.count_if(F.col("relationship").isin(*X.CITABLE)).alias("_strong_values"))
    grid = vocabulary.select("standard", "disclosure").join(sent_if_small(entities.select("entity")))
    rows = grid.join(per, "disclosure", "left").join(found, ["entity", "disclosure"], "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    status = (
        F.when(n("_confirmed") == 0, F.when(n("_rejected") > 0, "Not reported").when(n("_rows") > 0, proposed).otherwise("Not assessed"))
        .when((n("_gaps") > 0) | (n("_values") == 0), "Not reported")
        .when(n("_strong") == 0, "Partially reported")
        .otherwise("Reported")
    )
    values = F.when((n("_confirmed") > 0) & (n("_gaps") == 0), n("_values")).otherwise(0)
    return rows.select("entity", "standard", "disclosure", status.alias("status"), values.cast("long").alias("values_available"), ((n("_strong") > 0) & (values > 0)).alias("citable"), ((n("_strong_values") > 0) & (values > 0)).alias("citable_strict"))
