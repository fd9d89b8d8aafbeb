"""Lexical and dense vectors: TF-IDF as tables, nearest neighbours with filters and lanes, safe retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import fixed as X
from lodestone.functions.sizes import sent_if_small
from lodestone.operators.search import best_in_blocks

#: Terms up to which a vocabulary is broadcast: some 200 MB.
SENT_TERMS = 2_000_000


def term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf), stop words left out.

    Texts are dealt out by key once, before they become many rows; what is grouped by key later stays where it is.
    """
    found = docs.select(key, text).repartition(key).select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(X.TERM), F.lit(0))).alias("term"))
    return found.where(~F.col("term").isin(*X.STOPWORDS)).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(counts: DataFrame, n: int, least: int = X.MIN_DOC_FREQUENCY) -> DataFrame:
    """(term, df, idf) of the terms that ``least`` documents have; idf = ln((1 + n) / (1 + df)) + 1."""
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least)
    return df.withColumn("idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1)


def weights(counts: DataFrame, frequencies: DataFrame, key: str) -> DataFrame:
    """(key, term, w): (1 + ln tf) * idf, each key's weights of length 1; terms outside the table are dropped.

    Up to ``SENT_TERMS`` terms are sent to all tasks, for which a count reads the table: give it one that is written. Above, counts are shuffled.
    """
    raw = counts.join(sent_if_small(frequencies.select("term", "idf"), SENT_TERMS), "term").withColumn("_w", (1 + F.log("tf")) * F.col("idf"))
    norm = F.greatest(F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key))), F.lit(X.NORM_FLOOR))
    return raw.select(key, "term", (F.col("_w") / norm).alias("w"))


def lexical_scores(queries: DataFrame, items: DataFrame, query_key: str, item_key: str) -> DataFrame:
    """(query, item, score) of the pairs that share a term: the product of their weight tables.

    The queries' terms are sent to all tasks while they are few; then only what scores is shuffled.
    """
    return items.withColumnRenamed("w", "_v").join(sent_if_small(queries), "term").groupBy(query_key, item_key).agg(F.sum(F.col("w") * F.col("_v")).alias("score"))


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def top_k(scored: DataFrame, keys: list[str], k: int, tie: str) -> DataFrame:
    """The k best rows of each key with their rank, ties by ``tie``; Spark limits each task's groups before the exchange."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), tie))
    return scored.withColumn("rank", nth).where(F.col("rank") <= k)


def nearest(queries: DataFrame, items: DataFrame, k: int, min_score: float | None = None, apart: bool = True, digits: int | None = None) -> DataFrame:
    """(query_id, item_id, score, rank): exact search by cosine of a stated set of queries over all items, block by block.

    queries: query_id, query (vector). items: item_id, vector; filter them before, so that what is filtered out never
    takes a place among the k. See ``search.best_in_blocks`` for the rest.
    """
    return top_k(best_in_blocks(queries, items, k, apart=apart, min_score=min_score, digits=digits), ["query_id"], k, "item_id")


def nearest_by_lane(queries: DataFrame, items: DataFrame, k: int, first_lane: str, apart: bool = True, digits: int | None = None) -> DataFrame:
    """(query_id, item_id, lane, score, rank): ceil(k / 2) places for one lane, the rest for each other; items have a lane."""
    found = best_in_blocks(queries, items, k - (k + 1) // 2, {first_lane: (k + 1) // 2}, apart, digits=digits)
    return lane_quota(found, k, first_lane)


def lane_quota(scored: DataFrame, k: int, first_lane: str, query: str = "query_id") -> DataFrame:
    """The best ceil(k / 2) rows of one lane and the best rest of the others, ranked together.

    Meant for what blocks have left, a few rows of each query and lane.
    """
    nth = F.row_number().over(Window.partitionBy(query, "lane").orderBy(F.desc("score"), "item_id"))
    quota = F.when(F.col("lane") == first_lane, (k + 1) // 2).otherwise(k - (k + 1) // 2)
    kept = scored.withColumn("_nth", nth).where(F.col("_nth") <= quota).drop("_nth")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), "item_id")))


class LaneMisuse(ValueError):
    """A search that could mix institutions."""


def allowed(
    index: DataFrame, lane: str = "knowledge", institution: str | None = None, exclude_peer_reports: bool = True, language: str | None = "en",
    drop_quantities: bool = False, source_types: list[str] | None = None, pillars: list[str] | None = None,
) -> DataFrame:
    """The chunks that a search may show; safe unless told otherwise. Filter with it before anything is scored.

    index: lane, institution, source_type, language, has_quantity, pillar, and others. Lanes
    other than "knowledge" need an institution, of which alone they show chunks. Peer reports
    and other languages are left out of the knowledge lane.
    """
    if lane not in ("knowledge", "institution", "all"):
        raise ValueError(f"lane must be knowledge, institution or all, not {lane!r}")
    if lane != "knowledge" and not institution:
        raise LaneMisuse(f"lane {lane!r} needs an institution")
    if institution and not index.where((F.col("lane") == "institution") & (F.col("institution") == institution)).limit(1).count():
        raise LaneMisuse(f"unknown institution {institution!r}")
    own = (F.col("lane") == "institution") & (F.col("institution") == (institution or ""))
    general = F.col("lane") == "knowledge"
    if exclude_peer_reports:
        general = general & (F.col("source_type") != "peer_report")
    if language:
        general = general & (F.col("language") == language)
    rows = index.where({"knowledge": general, "institution": own, "all": general | own}[lane])
    for column, values in (("source_type", source_types), ("pillar", pillars)):
        rows = rows.where(F.col(column).isin(*values)) if values else rows
    return rows.where(~F.col("has_quantity")) if drop_quantities else rows


def retrieve(queries: DataFrame, index: DataFrame, k: int = 5, lane: str = "knowledge", institution: str | None = None, min_score: float = 0.0, digits: int | None = None, **filters: object) -> DataFrame:
    """The k best chunks for each query among those that may be shown: see ``allowed`` for the filters.

    index: item_id, vector, and what is filtered by. With lane "all" the institution's lane has ceil(k / 2) places.
    """
    rows = allowed(index, lane, institution, **filters)
    best = nearest_by_lane(queries, rows, k, "institution", apart=False, digits=digits) if lane == "all" else nearest(queries, rows, k, apart=False, digits=digits)
    return best.where(F.col("score") >= min_score)
