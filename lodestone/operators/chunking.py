"""Documents to chunks: greedy packing of paragraphs with overlap, as one fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import fixed as X
from lodestone.functions.text import has_quantity, let, word_count


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def paragraphs(c: Column) -> Column:
    """The lines that aren't blank, trimmed."""
    return F.filter(F.transform(F.split(c, r"\n"), strip), lambda p: p != "")


def chunks(c: Column, target: int = X.TARGET_CHARS, overlap: int = X.OVERLAP_CHARS, least: int = X.MIN_CHUNK_CHARS) -> Column:
    """An array of chunks of about ``target`` code points.

    Paragraphs are packed greedily; a chunk begins with the last ``overlap`` code points of the one
    before. A paragraph above the target is packed by sentences, alone and without overlap. What has
    fewer than ``least`` code points when it would become a chunk is dropped.
    """
    step = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    flush = F.array(step("flush", F.lit("")))
    sentences = lambda p: F.concat(flush, F.transform(F.split(p, r"(?<=[.!?])\s+"), lambda s: step("sentence", s)), flush)
    steps = F.flatten(F.transform(paragraphs(c), lambda p: F.when(F.length(p) > target, sentences(p)).otherwise(F.array(step("paragraph", p)))))

    def state(done: Column, text: Column) -> Column:
        return F.struct(done.alias("done"), text.alias("text"))

    # paragraphs, sentences and the text so far never have white space at their ends, so joining them needs no trimming
    kept = lambda s: F.when(F.length(s["text"]) >= least, F.concat(s["done"], F.array(s["text"]))).otherwise(s["done"])

    def fold(s: Column, x: Column) -> Column:
        text, new = s["text"], x["text"]
        sep = F.when(x["kind"] == "sentence", " ").otherwise("\n")
        tail = F.when(x["kind"] == "sentence", "").otherwise(strip(F.right(text, F.lit(overlap))))
        full = F.length(text) + F.length(new) + 1 > target
        return (
            F.when(x["kind"] == "flush", state(kept(s), F.lit("")))
            .when(text == "", state(s["done"], new))
            .when(full, state(kept(s), F.concat(let(tail, lambda t: F.when(t == "", "").otherwise(F.concat(t, sep))), new)))
            .otherwise(state(s["done"], F.concat(text, sep, new)))
        )

    begin = state(F.expr("cast(array() as array<string>)"), F.lit(""))
    return F.aggregate(steps, begin, fold, kept)


def chunk_records(docs: DataFrame, text: str = "text", min_words: int = X.MIN_DOC_WORDS, prefix: Column | None = None, parity: bool = False) -> DataFrame:
    """A row for each chunk of each document: its index, text, length, words and whether it claims a quantity.

    Documents of fewer than ``min_words`` words have none. A ``prefix`` is put before a chunk's text;
    the counts are those of the text without it. parity: see ``has_quantity``.
    """
    rows = docs.where(word_count(F.col(text)) >= min_words).select("*", F.posexplode(chunks(F.col(text))).alias("chunk_index", "chunk"))
    own = F.col("chunk")
    rows = rows.withColumn("chars", F.length(own)).withColumn("words", word_count(own)).withColumn("has_quantity", has_quantity(own, parity))
    return rows if prefix is None else rows.withColumn("chunk", F.concat(prefix, F.lit("\n"), own))


def indexable(docs: DataFrame, text: str = "text", extension: str = "extension", order: str = "doc_id") -> DataFrame:
    """Documents with ``skipped``: spreadsheet, oversized, duplicate (of an earlier body), or null for those to index."""
    from pyspark.sql import Window

    body = F.sha1(F.col(text))
    nth = F.row_number().over(Window.partitionBy("_body").orderBy(order))
    sheet, large = F.coalesce(F.col(extension).isin(*X.SPREADSHEET_EXTENSIONS), F.lit(False)), F.length(text) > X.MAX_DOC_CHARS
    early = F.when(sheet, "spreadsheet").when(large, "oversized")
    rows = docs.withColumn("_early", early).withColumn("_body", F.when(F.col("_early").isNull(), body).otherwise(F.concat(F.lit("skipped "), F.col(order).cast("string"))))
    return rows.withColumn("skipped", F.coalesce("_early", F.when(nth > 1, "duplicate"))).drop("_early", "_body")
