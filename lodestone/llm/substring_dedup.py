"""Substring deduplication: content-defined chunks, deduplicated by digest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import in_arrow, span_hashes, text_slices
from lodestone.sources.tables import table

#: Bytes that the rolling hash sees, and from how many positions on average one is a candidate.
GEAR_BYTES, MEAN = 16, 16
#: Bytes of a chunk: at least, but where a text ends, and at most, but for the rest of a code point.
SHORTEST, LONGEST = 12, 128
#: How often a chunk that is too long is cut where its hash is least, before it is cut by length.
ROUNDS = 3
#: Code points of repeated text in a row from which on it counts as a passage; of a passage of over
#: 50 words more than that lies between its first and its last boundary.
LEAST = 100


def gear_table() -> np.ndarray:
    return np.random.default_rng(712).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash at each byte: h = 2h + g[byte], which forgets all but 16 bytes.

    Computed for all bytes at once by doubling the number of bytes seen: 1, 2, 4, 8, 16.
    """
    h = gear_table()[raw]
    seen = 1
    while seen < GEAR_BYTES:
        out = h.copy()
        out[seen:] += h[:-seen] << np.uint16(seen)
        h, seen = out, 2 * seen
    return h


def boundaries(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the chunks of one text end (the byte after each), from its gear hashes and the bytes after which a code point ends.

    A byte at which the hash is small is a candidate; it counts if there is no other among the
    ``SHORTEST`` - 1 before it. Both depend on what stands just there alone, so after an insertion
    the boundaries are the old ones again. A chunk above ``LONGEST``, as in a text that repeats a
    short period, is cut where its hash is least, in a period each time.
    """
    small = np.flatnonzero((h < (1 << 16) // MEAN) & ends)
    cuts = small[np.diff(small, prepend=-SHORTEST) >= SHORTEST] + 1
    cuts = np.append(cuts[cuts < len(h)], len(h))
    for k in range(ROUNDS + 1):
        begin = np.concatenate(([0], cuts[:-1]))
        long = np.flatnonzero(cuts - begin > LONGEST)
        if not len(long):
            break
        more = [cuts]
        for a, b in zip(begin[long].tolist(), cuts[long].tolist(), strict=True):
            inner = np.flatnonzero(ends[a + SHORTEST - 1 : b - SHORTEST]) + a + SHORTEST - 1
            if k < ROUNDS:
                inner = inner[h[inner] == h[inner].min()] if len(inner) else inner
                more.append(spaced(inner + 1, SHORTEST))
            else:
                more.append(spaced(inner + 1, LONGEST - SHORTEST))
        cuts = np.unique(np.concatenate(more))
    return cuts


def spaced(places: np.ndarray, least: int) -> np.ndarray:
    """Of ascending places those that are ``least`` or more after the last one taken, from the first on."""
    out, k = [], 0
    while k < len(places):
        out.append(places[k])
        k = int(np.searchsorted(places, places[k] + least))
    return np.array(out, np.int64)


def chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each chunk of the texts in order: the text's number, its start and end there in code
    points, and a 64-bit digest."""
    parts = [np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    if not sizes.sum():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    raw = np.concatenate(parts)
    leads = (raw & 0xC0) != 0x80
    ends = np.append(leads[1:], True)
    stops = np.cumsum(sizes)
    end = np.concatenate([boundaries(gear_hashes(part), ends[e - len(part) : e]) + (e - len(part)) for part, e in zip(parts, stops.tolist(), strict=True) if len(part)])
    begin = np.concatenate(([0], end[:-1]))
    of = np.searchsorted(stops, begin, side="right")
    points = np.concatenate(([0], np.cumsum(leads)))
    base = points[(stops - sizes)[of]]
    return of, points[begin] - base, points[end] - base, span_hashes(raw, begin, end)


def again(of: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether a chunk's digest was in its own text before."""
    order = np.lexsort((digest, of))  # stable
    same = (of[order][1:] == of[order][:-1]) & (digest[order][1:] == digest[order][:-1])
    out = np.zeros(len(of), bool)
    out[order[1:]] = same
    return out


def chunked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _text, _start, _end and _digest of each chunk; _again, if it was in the same text before.

    _text is a hash of the whole text, which tells texts of one id apart.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                of, start, end, digest = chunks(texts)
                whole = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts), np.uint32, len(texts)).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of + first)), pa.array(whole[of]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(digest.view(np.int64)), pa.array(again(of, digest))],
                    names=["_id", "_text", "_start", "_end", "_digest", "_again"],
                )

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), run, f"_id {kind}, _text int, _start int, _end int, _digest long, _again boolean")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, whole: bool = False) -> DataFrame:
    """The passages of at least ``least`` code points that consist of chunks found more than once, in
    several documents or in one.

    A row for each passage of each document: id, start, end (code points, end exclusive), n_chars,
    first_doc (the smallest id among the holders of its chunks) and kept: true where this is the
    first place of all of them, so that the passage stays here and goes elsewhere; of places in
    one document the first counts. Null and empty texts have no passage. Rows that repeat an id and a text
    count as one document; different texts of one id are documents of their own, in the order of a hash of 32 bits,
    so that no passage crosses from one to another. Null ids come last.

    Short chunks of a passage are often in some earlier document as well. With ``whole``, less than
    ``least`` code points of these in a row are part of the passage around them, which its first
    holder keeps as a whole and is the first_doc of; more are a passage of their own. Without it they
    split the passage, and what is then shorter than ``least`` is not reported.

    Chunks are one if their 64-bit digests agree, into which content and length go. Counts cross an exchange as one
    row for each digest and map task, so a chunk that a third of all documents hold is no
    burden there; in the join back Spark splits its partition.
    """
    apart = several_texts(docs, id_col, text_col)
    # where each id has one text it is who a chunk belongs to; else the id and the text's hash are, nulls last
    who = F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"), F.col("_text").alias("text")) if apart else F.col("_id")
    found = chunked(docs, id_col, text_col).select(who.alias("_who"), "_start", "_end", "_digest", "_again")
    several = (F.col("_first") < F.col("_last")) | F.col("_repeats") | (F.col("_nulls") & F.col("_first").isNotNull())
    held = found.groupBy("_digest").agg(F.min("_who").alias("_first"), F.max("_who").alias("_last"), F.max("_again").alias("_repeats"), F.max(F.col("_who").isNull()).alias("_nulls")).where(several)
    held = held.select(F.col("_digest").alias("_held"), "_first")
    kept = F.col("_who").eqNullSafe(F.col("_first")) & ~F.col("_again")
    shared = found.join(held, F.col("_digest") == F.col("_held")).select("_who", "_start", "_end", "_first", kept.alias("_kept"))
    shared = shared.groupBy("_who", "_start", "_end").agg(F.min("_first").alias("_first"), F.min("_kept").alias("_kept"))
    order = Window.partitionBy("_who").orderBy("_start", "_end")
    touches = F.lag("_end").over(order) == F.col("_start")
    passages = joined(shared, touches & (F.lag("_kept").over(order) == F.col("_kept")))
    first = F.col("_first")
    if whole:
        passages = passages.withColumn("_other", ~F.col("_kept") & (F.col("_end") - F.col("_start") >= least))
        passages = joined(passages, touches & ~F.col("_other") & ~F.lag("_other").over(order))
        first = F.when(F.col("_kept"), F.col("_who")).otherwise(first)
    size = F.col("_end") - F.col("_start")
    id_of = lambda c: c["id"] if apart else c
    return passages.where(size >= least).select(id_of(F.col("_who")).alias(id_col), F.col("_start").alias("start"), F.col("_end").alias("end"), size.alias("n_chars"), id_of(first).alias("first_doc"), F.col("_kept").alias("kept"))


def several_texts(docs: DataFrame, id_col: str, text_col: str) -> bool:
    """Whether some id, or null, has different texts: by their hashes, of which a row for each id and map task is shuffled."""
    hashed = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"))
    return hashed.groupBy("_id").agg(F.min("_hash").alias("_low"), F.max("_hash").alias("_high")).where("_low <> _high").limit(1).count() > 0


def joined(parts: DataFrame, on: Column) -> DataFrame:
    """Each text's parts in order, those that ``on`` joins to the one before as one; kept if one of them is."""
    order = Window.partitionBy("_who").orderBy("_start", "_end")
    runs = parts.withColumn("_new", F.when(on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy("_who", "_run").agg(F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.min("_first").alias("_first"), F.max("_kept").alias("_kept")).drop("_run")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole passages of 100 code points or more that are in several places of all documents; as of ``repeated_passages``."""
    return repeated_passages(table(spark, sf_dir, "documents"), whole=True)
