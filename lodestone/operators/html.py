"""Pages as streams of tags: text events, headings carried forward, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import absolute_links, collapse_space


def without_code(html: Column) -> Column:
    """Without scripts, styles and navigation."""
    return F.regexp_replace(html, r"(?is)<(script|style|nav)\b[^>]*>.*?</\1>", " ")


def plain(fragment: Column) -> Column:
    """A fragment's text: tags out, the commonest entities read, white space collapsed; what is raised
    or lowered stays with its word."""
    text = F.regexp_replace(F.regexp_replace(fragment, r"(?i)</?su[bp]\b[^>]*>", ""), r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse_space(text)


def events(pages: DataFrame, key: str, html: str, tags: tuple[str, ...] = ("h1", "h2", "h3", "h4", "h5", "p", "li")) -> DataFrame:
    """(key, ord, tag, text): what follows each opening tag up to the next of them or its closing.

    Needs no closing tag, which pages often lack.
    """
    names = "|".join(tags)
    found = F.regexp_extract_all(without_code(F.col(html)), F.lit(rf"(?is)<(?:{names})\b[^>]*>(?:(?!</?(?:{names})\b).)*"), F.lit(0))
    rows = pages.select(key, F.posexplode(found).alias("ord", "_raw"))
    tag = F.lower(F.regexp_extract("_raw", r"^<([A-Za-z0-9]+)", 1))
    return rows.select(key, "ord", tag.alias("tag"), plain(F.regexp_replace("_raw", r"(?s)^<[^>]*>", "")).alias("text"))


def under_headings(found: DataFrame, key: str, outer: str = "h1", inner: str = "h2") -> DataFrame:
    """The events with the heading and the section they stand under; a new outer heading ends the section."""
    order = Window.partitionBy(key).orderBy("ord")
    of = lambda tag: F.when(F.col("tag") == tag, F.col("text"))
    rows = found.withColumn("heading", F.last(of(outer), ignorenulls=True).over(order)).withColumn("_part", F.sum(F.when(F.col("tag") == outer, 1).otherwise(0)).over(order))
    within = Window.partitionBy(key, "_part").orderBy("ord")
    return rows.withColumn("section", F.last(of(inner), ignorenulls=True).over(within)).drop("_part")


def pair_titles(found: DataFrame, key: str, title: str, well: str) -> DataFrame:
    """Each title with the next well after it; a well serves the first title that claims it, others get null."""
    # backwards, so that the frame only grows
    after = Window.partitionBy(key).orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    at = F.last(F.when(F.col("tag") == well, F.struct("ord", "text")), ignorenulls=True).over(after)
    titles = found.withColumn("_well", at).where(F.col("tag") == title)
    claim = F.row_number().over(Window.partitionBy(key, "_well.ord").orderBy("ord"))
    return titles.withColumn("_claim", claim).select(key, "ord", F.col("text").alias("title"), F.when(F.col("_claim") == 1, F.col("_well.text")).alias("value"))


def links(html: Column, base: str = "") -> Column:
    return absolute_links(F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1)), base)


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, ord, href, link, cells): the rows of a page's tables, their first link and its text, and the texts of their cells."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(without_code(F.col(html)), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("ord", "_row"))
    cells = F.transform(F.regexp_extract_all("_row", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</tr>|$)"), F.lit(1)), plain)
    link = plain(F.regexp_extract("_row", r"""(?is)<a\b[^>]*\bhref\b[^>]*>(.*?)</a>""", 1))
    return rows.select(key, "ord", F.regexp_extract("_row", r"""(?i)\bhref\s*=\s*["']([^"']*)["']""", 1).alias("href"), link.alias("link"), cells.alias("cells"))
