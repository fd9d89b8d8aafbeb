"""From cached pages to records: a scorecard's credits, and the fields that a credit's page states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import fixed as X
from lodestone.functions import values as V
from lodestone.operators import html as H
from lodestone.operators.joins import keep, pick
from lodestone.sources import config, schemas

#: Where a heading's block, a field's name or its answer begins.
MARKED = r"""(?i)(?=<(?:div|span)\b[^>]*\bclass\s*=\s*["'][^"']*(?<![\w-])(?:field-header|scorecardFieldTitle|well)(?![\w-]))"""
CLASSES = r"""(?i)^<[^>]*?\bclass\s*=\s*["']([^"']*)["']"""


def scorecard(pages: DataFrame, institution: str = "institution", html: str = "html") -> DataFrame:
    """Rows of SCORES: a row for each credit that a scorecard's tables link to, the first of each code.

    Rows without a link to a report, such as headings, and codes of no known category are left out.
    Of "a / b" both numbers may be missing.
    """
    rows = H.table_rows(pages, institution, html).where(F.contains("href", F.lit("/report/")) & (F.size("cells") > 0))
    parts = F.filter(F.split("href", "/"), lambda p: p != "")
    rows = rows.withColumn("credit_code", F.try_element_at(parts, F.lit(-1))).withColumn("category_code", F.coalesce(F.try_element_at(parts, F.lit(-3)), F.lit("")))
    rows = rows.withColumn("category", config.looked_up(F.col("category_code"), config.CATEGORY_NAMES, "")).where("category <> ''")
    score, most = V.score_pair(F.element_at("cells", -1))
    both = score.isNotNull() & most.isNotNull()
    rows = rows.withColumn("score", F.when(both, score)).withColumn("max", F.when(both, most)).withColumn("status", F.coalesce(F.try_element_at("cells", F.lit(2)), F.lit("")))
    first = keep(rows, [institution, "credit_code"], [F.col("ord")])
    return pick(first.withColumnRenamed(institution, "institution").withColumnRenamed("link", "credit_name"), schemas.SCORES.fieldNames())


def enclosed(block: Column) -> Column:
    """What an opening div or span at the start of a block encloses, divs within it whole; up to the block's end if it isn't closed."""
    inner = F.regexp_replace(block, r"(?s)^<[^>]*>", "")
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))
    step = F.regexp_extract_all(F.concat(F.lit("<!>"), inner), F.lit(r"(?is)</?div\b[^>]*>[^<]*|<[^<]*"), F.lit(0))

    def read(state: Column, part: Column) -> Column:
        depth = state["depth"] + F.when(part.rlike(r"(?i)^</div\b"), -1).when(part.rlike(r"(?i)^<div\b"), 1).otherwise(0)
        return F.when(state["depth"] <= 0, state).otherwise(F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(state["text"], part)).otherwise(state["text"]).alias("text")))

    of_div = F.regexp_replace(F.aggregate(step, start, read)["text"], "^<!>", "")
    return F.when(block.rlike("(?i)^<span"), F.regexp_extract(inner, r"(?is)^(.*?)(?:</span|$)", 1)).otherwise(of_div)


def answer(well: Column) -> tuple[Column, Column]:
    """A well's value and unit: italics at the end are the unit of a bare number, else part of the value."""
    head = H.plain(F.regexp_replace(well, r"(?is)<i\b[^>]*>.*?</i>", ""))
    last = F.try_element_at(F.regexp_extract_all(well, F.lit(r"(?is)<i\b[^>]*>(.*?)</i>"), F.lit(1)), F.lit(-1))
    bare = last.isNotNull() & head.rlike(X.NUMERIC)
    whole = H.plain(well)
    value = F.when(bare, head).when(whole.isin(*X.NOT_REPORTED), "").otherwise(whole)
    return F.coalesce(value, F.lit("")), F.when(bare, H.plain(last)).otherwise("")


def fields(pages: DataFrame, institution: str = "institution", code: str = "credit_code", html: str = "html", base: str = "") -> DataFrame:
    """Rows of FIELDS: a row for each field of each credit's page, under the indicator and section it stands in.

    A block of headings with an h4 begins an indicator and ends the section; an h5 begins a section. A
    field's answer is the next well, unless an earlier field has that one. base: what relative links
    begin with.
    """
    page = pages.select(F.struct(F.col(institution).alias("institution"), F.col(code).alias("code")).alias("_page"), H.without_code(F.col(html)).alias("_html"))
    heading = H.plain(F.regexp_extract("_html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))
    name = F.regexp_extract(heading, r"\b[A-Z]{2,4}-[0-9]+:\s*(.+)$", 1)
    titles = page.select("_page", F.when(name != "", name).otherwise(heading).alias("credit_name"))
    blocks = page.select("_page", F.posexplode(F.split("_html", MARKED)).alias("_nth", "_raw"))
    has = lambda c: F.array_contains(F.split(F.regexp_extract("_raw", CLASSES, 1), r"\s+"), c)
    blocks = blocks.withColumn("_in", enclosed(F.col("_raw")))
    level = lambda t: F.when(F.col("_in").rlike(rf"(?is)<{t}\b"), F.struct(F.lit(t).alias("tag"), H.plain(F.regexp_extract("_in", rf"(?is)<{t}\b[^>]*>(.*?)(?:</{t}|$)", 1)).alias("text")))
    one = lambda t, text: F.array(F.struct(F.lit(t).alias("tag"), text.alias("text")))
    found = (
        F.when(has("field-header"), F.array_compact(F.array(level("h4"), level("h5")))).when(has("scorecardFieldTitle"), one("title", F.rtrim(H.plain(F.col("_in")), F.lit(":"))))
        .when(has("well"), one("well", F.col("_in")))
    )
    events = blocks.select("_page", "_nth", F.posexplode(found).alias("_sub", "_e")).select("_page", (2 * F.col("_nth") + F.col("_sub")).alias("ord"), "_e.tag", "_e.text")
    under = H.under_headings(events, "_page", "h4", "h5").select("_page", "ord", F.coalesce("heading", F.lit("")).alias("indicator"), F.coalesce("section", F.lit("")).alias("section"))
    rows = H.pair_titles(events, "_page", "title", "well").withColumnRenamed("title", "field").join(under, ["_page", "ord"]).join(titles, "_page")
    value, units = answer(F.coalesce("value", F.lit("")))
    rows = rows.withColumn("links", F.array_join(H.links(F.coalesce("value", F.lit("")), base), " ")).withColumn("units", units).withColumn("value", value)
    rows = rows.select("*", F.col("_page.institution").alias("institution"), F.col("_page.code").alias("credit_code"))
    rows = rows.withColumn("category", F.split_part("credit_code", F.lit("-"), F.lit(1))).withColumn("pillar", V.pillar(F.col("credit_code")))
    rows = rows.withColumn("value_numeric", V.value_numeric(F.col("value"))).withColumn("value_type", V.value_type(F.col("field"), F.col("value"), F.col("units")))
    return rows.select(*schemas.FIELDS.fieldNames(), "ord")


def few_questions(rows: DataFrame, least: int = 20) -> DataFrame:
    """(institution, questions) of institutions with suspiciously few different fields: a sign that pages were read wrongly."""
    return rows.groupBy("institution").agg(F.countDistinct("field").alias("questions")).where(F.col("questions") < least)
