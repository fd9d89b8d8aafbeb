"""What a standard asks for, read from its pages, and whether a vocabulary agrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import fixed as X
from lodestone.operators.markup import text_blocks

HEADING = r"^(?:Disclosure\s+)?([0-9]{1,3}-[0-9]{1,2})\s+(.+)$"
GUIDANCE = r"(?i)^guidance\b"


def is_guidance(tag: str = "tag", text: str = "text", heading: str = GUIDANCE) -> Column:
    """Whether a line begins what isn't binding: a heading that says so, or any line that is one of the fixed markers."""
    low = F.lower(text)
    return (F.col(tag).startswith("h") & F.col(text).rlike(heading)) | F.rtrim(low, F.lit(":")).isin(*X.GUIDANCE_MARKERS) | low.startswith(X.GUIDANCE_PREFIX)


def extract_requirements(pages: DataFrame, key: str, html: str, heading: str = HEADING, guidance: str = GUIDANCE, size: str | None = None) -> DataFrame:
    """(page, number, title, text): what stands below each disclosure's heading, up to the next
    heading of its rank or the guidance. A number's first heading counts. See ``markup.text_blocks`` for what is read of a page."""
    found = text_blocks(pages, key, html, size=size)
    top = F.col("tag").isin("h1", "h2")
    order = Window.partitionBy(key).orderBy("ord")
    rows = found.withColumn("_part", F.sum(F.when(top, 1).otherwise(0)).over(order))
    within = Window.partitionBy(key, "_part").orderBy("ord")
    rows = rows.withColumn("_head", F.first("text").over(within)).withColumn("_guided", F.max(~top & is_guidance(heading=guidance)).over(within))
    body = rows.where(~top & (F.col("_part") > 0) & ~F.col("_guided") & F.col("_head").rlike(heading))
    lines = F.array_sort(F.collect_list(F.struct("ord", "text")))
    parts = body.groupBy(key, "_part", "_head").agg(F.array_join(F.transform(lines, lambda s: s["text"]), "\n").alias("text"))
    parts = parts.select(key, "_part", F.regexp_extract("_head", heading, 1).alias("number"), F.regexp_extract("_head", heading, 2).alias("title"), "text")
    first = F.row_number().over(Window.partitionBy(key, "number").orderBy("_part"))
    return parts.withColumn("_nth", first).where("_nth = 1").drop("_nth", "_part")


def cross_check(requirements: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(number, finding): title differs (case aside), missing on the pages, or unlisted in the vocabulary."""
    r = requirements.select("number", F.col("title").alias("_page"))
    v = vocabulary.select(F.col("disclosure").alias("number"), F.col("title").alias("_listed"))
    differs = r.join(v, "number").where(F.lower("_page") != F.lower("_listed")).select("number", F.lit("title differs").alias("finding"))
    missing = v.join(r, "number", "left_anti").select("number", F.lit("missing").alias("finding"))
    return differs.unionByName(missing).unionByName(r.join(v, "number", "left_anti").select("number", F.lit("unlisted").alias("finding")))
