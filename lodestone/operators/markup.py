"""Nested markup as rows: tags and texts of pages, how deep each stands, where subtrees end, and whose text each is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.sizes import dealt_by_key
from lodestone.functions.text import collapse_space

#: Code units of markup that one task takes apart, about; its tokens are sorted and carried through windows several times.
TASK_CHARS = 16_000_000
#: A tag, a text, or a sign that is neither.
TOKEN = r"(?s)</?[A-Za-z][^>]*>|[^<]+|<"
UNREAD = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
#: Fixed: elements without an end, and those at whose tags a paragraph ends.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
BLOCKS = [
    "address", "article", "aside", "blockquote", "body", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
]
LISTS = ["ul", "ol"]


def entities(c: Column) -> Column:
    """The commonest named and all numbered character references read."""
    whole = c
    for name, char in (("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'")):
        c = F.replace(c, F.lit(name), F.lit(char))
    of = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    valid = lambda n: (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)

    def read(text: Column, pattern: str, base: int) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        step = lambda acc, n: F.when(valid(F.conv(n, base, 10).cast("long")), F.regexp_replace(acc, F.concat(F.lit("&#[xX]?0*" if base == 10 else "&#[xX]0*"), F.ltrim(n, F.lit("0")), F.lit(";")), of(F.conv(n, base, 10).cast("long")))).otherwise(acc)
        return F.aggregate(found, text, step)

    found = F.replace(read(read(c, "&#([0-9]{1,7});", 10), "&#[xX]([0-9A-Fa-f]{1,6});", 16), F.lit("&amp;"), F.lit("&"))
    return F.when(F.contains(whole, F.lit("&")), found).otherwise(whole)


def tokens(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, ord, raw, tag, step, classes): the tags and texts of pages in order; tag is empty for a text, step 1 where an element begins and -1 where it ends.

    A tag without attributes has no classes. Comments, scripts and styles are left out; null has no row.
    """
    named = lambda raw: F.struct(raw.alias("raw"), F.lower(F.regexp_extract(raw, r"^</?([A-Za-z][A-Za-z0-9]*)", 1)).alias("tag"))
    found = F.transform(F.regexp_extract_all(F.regexp_replace(html, UNREAD, ""), F.lit(TOKEN), F.lit(0)), named)
    rows = pages.select(key, F.posexplode(found).alias("ord", "_token")).select(key, "ord", "_token.raw", "_token.tag")
    tag = F.col("tag")
    step = F.when((tag == "") | tag.isin(*VOID), 0).when(F.startswith("raw", F.lit("</")), -1).otherwise(1)
    quoted = F.regexp_extract("raw", r"""(?is)^<[^>]*?\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", 0)
    classes = F.split(F.trim(F.regexp_replace(F.regexp_replace(quoted, r"(?is)^.*?\sclass\s*=\s*", ""), "[\"']", "")), r"\s+")
    return rows.select(key, "ord", "raw", "tag", step.alias("step"), F.when((step == 1) & (F.length("raw") > F.length(tag) + 2), classes).alias("classes"))


def with_depths(rows: DataFrame, key: str, of: dict[str, Sequence[str]]) -> DataFrame:
    """The tokens with, for each name, how many elements of its tags are open after them: a running sum of steps.

    Ends without a beginning don't count; a tag's depth has nothing to do with other tags, so that ends which pages leave out, as those of
    paragraphs and items, do no harm.
    """
    order = Window.partitionBy(key).orderBy("ord")
    sums = rows.withColumns({f"_sum_{name}": F.sum(F.when(F.col("tag").isin(*tags), F.col("step")).otherwise(0)).over(order) for name, tags in of.items()})
    lows = {name: F.least(F.lit(0), F.min(f"_sum_{name}").over(order)) for name in of}
    return sums.withColumns({name: F.col(f"_sum_{name}") - low for name, low in lows.items()}).drop(*[f"_sum_{name}" for name in of])


def within_first(rows: DataFrame, key: str, begins: Column, depth: str, out: str) -> DataFrame:
    """The tokens with whether they are in the first element that ``begins`` marks, up to where its tag's depth falls below that of its beginning; in all, if none is marked."""
    page = Window.partitionBy(key)
    rows = rows.withColumns({"_from": F.min(F.when(begins, F.col("ord"))).over(page), "_level": F.min_by(F.when(begins, F.col(depth)), F.when(begins, F.col("ord"))).over(page)})
    rows = rows.withColumn("_upto", F.min(F.when((F.col("ord") > F.col("_from")) & (F.col(depth) < F.col("_level")), F.col("ord"))).over(page))
    inside = F.col("_from").isNull() | ((F.col("ord") > F.col("_from")) & (F.col("_upto").isNull() | (F.col("ord") < F.col("_upto"))))
    return rows.withColumn(out, inside).drop("_from", "_level", "_upto")


def outermost(rows: DataFrame, key: str, marked: Column, tag: str, depth: str) -> DataFrame:
    """The tokens with _top, where they are in an outermost element of a tag that ``marked`` marks: the ord of its beginning.

    Beginnings and ends of one depth alternate, so an element ends at the next token of its own depth.
    """
    level = F.when(F.col("tag") == tag, F.when(F.col("step") == 1, F.col(depth)).when(F.col("step") == -1, F.col(depth) + 1))
    rows = rows.withColumn("_at", level)
    end = F.coalesce(F.lead("ord").over(Window.partitionBy(key, "_at").orderBy("ord")), F.lit(2**31 - 1))
    rows = rows.withColumn("_end", F.when(marked, end))
    order = Window.partitionBy(key).orderBy("ord")
    before = F.max("_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_own", F.col("_end").isNotNull() & (F.coalesce(before, F.lit(-1)) < F.col("ord")))
    last = lambda c: F.last(F.when(F.col("_own"), F.col(c)), ignorenulls=True).over(order)
    rows = rows.withColumns({"_begin": last("ord"), "_until": last("_end")})
    return rows.withColumn("_top", F.when(F.col("ord") < F.col("_until"), F.col("_begin"))).drop("_at", "_end", "_own", "_begin", "_until")


def text_blocks(
    pages: DataFrame, key: str, html: str, scope: str = "doc-body", hidden: Sequence[str] = ("nav", "header", "footer"), promoted: Sequence[str] = ("heading", "h2"),
    size: str | None = None,
) -> DataFrame:
    """(key, ord, tag, text): headings h1 to h3, paragraphs and list items of pages, each with the text that is its own.

    Only what is within the first div of class ``scope`` counts, or all where a page has none; never what is within ``hidden``
    elements. A span of a class in ``promoted`` is a heading h2, spans within it included. An item's text is without that of
    lists and paragraphs within it, which speak for themselves; an item that goes on after them has one text. Tags within
    a text leave nothing, as in CO<sub>2</sub>, but a space in headings.

    Pages are dealt out whole, by their key and in tasks of ``TASK_CHARS`` at most, about, before they are taken apart: no token is shuffled.
    A column ``size`` stands for the length of markup that isn't stored, so that it needn't be made twice.
    """
    pages = dealt_by_key(pages.select(key, html, *[size] * (size is not None)), key, F.col(size) if size else F.length(html), TASK_CHARS)
    # windows carry what has a say in them: texts, tags of blocks, lists and spans, and whether their classes are those asked for
    begins = lambda tag, marked: (F.col("tag") == tag) & (F.col("step") == 1) & marked
    rows = tokens(pages, key, html).where(F.col("tag").isin("", "span", *BLOCKS, *hidden)).select(
        key, "ord", F.when(F.col("tag") == "", F.col("raw")).alias("raw"), "tag", "step",
        begins("div", F.array_contains("classes", scope)).alias("_scoped"), begins("span", F.arrays_overlap("classes", F.array(*map(F.lit, promoted)))).alias("_promoted"),
    )
    rows = with_depths(rows, key, {**{f"_in_{t}": [t] for t in hidden}, "_div": ["div"], "_span": ["span"], "_list": LISTS})
    shown = F.lit(True)
    for t in hidden:
        shown = shown & (F.col(f"_in_{t}") == 0) & (F.col("tag") != t)
    rows = within_first(rows, key, F.col("_scoped"), "_div", "_scope").withColumn("_shown", F.col("_scope") & shown).drop("_scoped", "_scope", *[f"_in_{t}" for t in hidden])
    rows = outermost(rows, key, F.col("_shown") & F.col("_promoted"), "span", "_span").drop("_promoted", "_span", "_div")
    order = Window.partitionBy(key).orderBy("ord")
    edge = F.when(F.col("tag").isin(*BLOCKS) & (F.col("step") != 0), F.struct("ord", "tag", "step"))
    # items and the lists they are in, by the number of open lists
    among = Window.partitionBy(key, "_list").orderBy("ord")
    item, of = F.when((F.col("tag") == "li") & (F.col("step") != 0), F.struct("ord", "step")), F.when(F.col("tag").isin(*LISTS) & (F.col("step") == 1), F.col("ord"))
    rows = rows.withColumn("_block", F.last(edge, ignorenulls=True).over(order)).withColumns({"_item": F.last(item, ignorenulls=True).over(among), "_of": F.last(of, ignorenulls=True).over(among)})
    owner = (
        F.when(F.col("_top").isNotNull(), F.struct(F.col("_top").alias("ord"), F.lit("h2").alias("tag")))
        .when((F.col("_block.step") == 1) & F.col("_block.tag").isin("h1", "h2", "h3", "p"), F.struct("_block.ord", "_block.tag"))
        .when((F.col("_item.step") == 1) & (F.col("_item.ord") > F.coalesce("_of", F.lit(-1))), F.struct(F.col("_item.ord").alias("ord"), F.lit("li").alias("tag")))
    )
    texts = rows.where((F.col("tag") == "") & F.col("_shown")).select(key, owner.alias("_owner"), "ord", "raw").where("_owner is not null")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("ord", "raw"))), lambda s: s["raw"])
    whole = texts.groupBy(key, "_owner").agg(parts.alias("_parts"))
    joined = F.when(F.startswith("_owner.tag", F.lit("h")), F.array_join("_parts", " ")).otherwise(F.array_join("_parts", ""))
    # a condition on the text would be pushed below and read it twice
    text = F.filter(F.array(collapse_space(entities(joined))), lambda t: t != "")
    return whole.select(key, "_owner.ord", "_owner.tag", F.explode(text).alias("text"))
