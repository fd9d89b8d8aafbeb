"""Similarity self-join on word shingles: MinHash bands, Bayesian pruning, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.sizes import sent_if_small
from lodestone.llm.common import checkpointed, in_arrow, mixed, text_slices, word_hashes, word_table
from lodestone.llm.components import components
from lodestone.sources.tables import table

WORDS = 5
THRESHOLD = 0.8
#: MinHash values of a set, and how often a pair at the threshold may share no band of them, at most.
HASHES, MISSED = 128, 1e-6
#: MinHash values that are compared at once, and the posterior below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-6
#: Sets of a bucket that meet in one task, and their shingles, about; larger buckets meet block by block.
BLOCK, BLOCK_ITEMS = 2048, 1_000_000
PAIRS_AT_ONCE = 1 << 15


def shingles(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``words`` words.

    Words are runs of letters and digits in lower case. A text of fewer words, but at least one,
    has one shingle of all of them; one without words has none.
    """
    hashes, counts = word_hashes([t.lower() for t in texts], word_table())
    n = len(hashes)
    run = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        run = mixed(run ^ hashes[k : k + len(run)]) + np.uint64(k)
    out, begin = [], 0
    for count in counts.tolist():
        if count >= words:
            own = np.sort(run[begin : begin + count - words + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif count:
            digest = hashlib.blake2b(hashes[begin : begin + count].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(digest, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        begin += count
    return out


def key_of(items: np.ndarray) -> bytes:
    """A 128-bit digest of a set."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def minhashes(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """A row of MinHash values (unsigned 32-bit) for each set; of an empty set the largest."""
    rng = np.random.default_rng(20240917)
    scale = rng.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, hashes, dtype=np.uint32)
    out = np.full((len(sets), hashes), 0xFFFFFFFF, np.uint32)
    some = [k for k, s in enumerate(sets) if len(s)]
    if some:
        flat = (np.concatenate([sets[k] for k in some]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(sets[k]) for k in some[:-1]])
        value = np.empty_like(flat)
        for k in range(hashes):
            np.multiply(flat, scale[k], out=value)
            value += shift[k]
            out[some, k] = np.minimum.reduceat(value, starts)
    return out


def band_rows(threshold: float, hashes: int = HASHES, missed: float = MISSED) -> int:
    """The most values of a band with which a pair at the threshold shares a band but for ``missed``: at 0.8 four, 32 bands of which miss one in twenty million."""
    return next((r for r in range(8, 1, -1) if (1 - threshold**r) ** (hashes // r) <= missed), 1)


def least_matches(threshold: float, tolerance: float = TOLERANCE, hashes: int = HASHES, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): of n values compared, fewer than m equal ones leave a pair with a posterior
    probability below ``tolerance`` of reaching the threshold, from a uniform prior.

    The posterior after m of n is Beta(m + 1, n - m + 1); its tail is a binomial sum.
    """
    out = []
    for n in range(step, hashes + 1, step):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append((n, m))
    return out


@dataclass
class Member:
    """One of a bucket's different sets. buckets: for each band the bucket, or 0 if it is alone there."""

    key: bytes
    weight: int
    part: int
    values: np.ndarray
    buckets: np.ndarray
    items: np.ndarray


def linked(members: list[Member], bucket: int, parts: tuple[int, int], threshold: float, least: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The pairs of members, from parts i and j, that reach the threshold.

    A pair that shares several buckets counts in that of the smallest number alone. MinHash values
    are compared step by step; what is left is verified on the whole sets.
    """
    values, buckets = np.stack([m.values for m in members]), np.stack([m.buckets for m in members])
    sizes = np.fromiter((len(m.items) for m in members), np.int64, len(members))
    part = np.fromiter((m.part for m in members), np.int64, len(members))
    own, other = np.flatnonzero(part == parts[0]), np.flatnonzero(part == parts[1])
    left: dict[int, list[np.ndarray]] = {}
    rows = max(1, PAIRS_AT_ONCE // max(1, len(other)))
    for begin in range(0, len(own), rows):
        a, b = (x.ravel() for x in np.meshgrid(own[begin : begin + rows], other, indexing="ij"))
        stay = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b]) - 1e-9
        if parts[0] == parts[1]:
            stay &= a < b
        a, b = a[stay], b[stay]
        shared = buckets[a]
        shared = np.where((shared == buckets[b]) & (shared != 0), shared, np.iinfo(np.int64).max)
        stay = shared.min(axis=1) == bucket
        a, b = a[stay], b[stay]
        equal = np.zeros(len(a), np.int64)
        done = 0
        for n, m in least:
            equal += (values[a, done:n] == values[b, done:n]).sum(axis=1)
            done = n
            stay = equal >= m
            a, b, equal = a[stay], b[stay], equal[stay]
        for k in np.unique(a).tolist():
            left.setdefault(k, []).append(b[a == k])
    if not left:
        return
    flat = np.concatenate([m.items for m in members])
    ids = np.unique(flat, return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mark = np.zeros(int(ids.max()) + 1, bool)
    for k, found in left.items():
        partners = np.concatenate(found)
        mark[ids[starts[k] : ends[k]]] = True
        if 4 * len(partners) > len(members):
            common = np.add.reduceat(mark[ids].astype(np.int64), starts)[partners]
        else:
            common = np.fromiter((np.count_nonzero(mark[ids[starts[p] : ends[p]]]) for p in partners.tolist()), np.int64, len(partners))
        mark[ids[starts[k] : ends[k]]] = False
        near = common >= threshold * (sizes[k] + sizes[partners] - common) - 1e-9
        for p in partners[near].tolist():
            yield k, p


def block_links(members: list[Member], bucket: int, parts: tuple[int, int], threshold: float, least: list[tuple[int, int]]) -> list[tuple[bytes, int, bytes]]:
    """(key, links, root) of each member that has links here: the rows it is linked to, and the
    smallest key that the block connects it with."""
    members = list({m.key: m for m in members}.values())
    up = list(range(len(members)))

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    links = [0] * len(members)
    for a, b in linked(members, bucket, parts, threshold, least):
        links[a] += members[b].weight
        links[b] += members[a].weight
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b, key=lambda k: members[k].key)] = min(a, b, key=lambda k: members[k].key)
    return [(m.key, links[k], members[root(k)].key) for k, m in enumerate(members) if links[k]]


def signed(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """_id, _hash (of the text), _key (a 128-bit digest of the set of shingles), _n (its size) and _sig of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, rows = [], [], []
            for _, texts in text_slices(batch.column(1)):
                sets = shingles(texts, words)
                keys += map(key_of, sets)
                sizes += map(len, sets)
                rows += [row.tobytes() for row in minhashes(sets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary())], names=["_id", "_hash", "_key", "_n", "_sig"])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col)), run, f"_id {kind}, _hash long, _key binary, _n long, _sig binary")


def places(sets: DataFrame, rows: int) -> DataFrame:
    """_key, _n, _first, _weight and _sig of the sets that share a bucket with another; _own: for each
    band of ``rows`` values its bucket, or 0; _in: the different buckets and their sizes.

    A bucket is named by the least of its bands' hashes; bands with the same members are one bucket.
    """
    n_bands = HASHES // rows
    hashes = [F.xxhash64(F.lit(k), F.expr(f"substring(_sig, {1 + k * 4 * rows}, {4 * rows})")) for k in range(n_bands)]
    bands = sets.select("_key", F.posexplode(F.array(*hashes)).alias("_band", "_hash"))
    buckets = (
        bands.groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_size"), F.bit_xor(F.xxhash64("_key")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "_key")).alias("_y"))
        .where("_size > 1")
    )
    same = buckets.groupBy("_size", "_x", "_y").agg(F.min("_hash").alias("_bucket"))
    named = buckets.join(same, ["_size", "_x", "_y"]).select("_hash", "_bucket", "_size")
    placed = merged(checkpointed(bands.join(named, "_hash").select("_key", "_band", "_bucket", "_size")))
    own = F.array(*[F.coalesce(F.element_at("_map", F.lit(k)), F.lit(0).cast("long")) for k in range(n_bands)])
    at = (
        placed.groupBy("_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("_band", "_bucket"))).alias("_map"), F.collect_set(F.struct("_bucket", "_size")).alias("_in"))
        .select("_key", own.alias("_own"), "_in")
    )
    return sets.join(at, "_key").select("_key", "_n", "_first", "_weight", "_sig", "_own", "_in")


def in_parts(candidates: DataFrame) -> DataFrame:
    """A row for each set and bucket, with the bucket's number of parts.

    There are as many as its sets and their shingles need.
    """
    placed = candidates.select("*", F.inline("_in")).drop("_in")
    heavy = placed.groupBy("_bucket").agg(F.sum("_n").alias("_items")).where(F.col("_items") > BLOCK_ITEMS).withColumnRenamed("_bucket", "_heavy")
    most = F.greatest(F.ceil(F.col("_size") / BLOCK), F.ceil(F.coalesce("_items", F.lit(0)) / BLOCK_ITEMS))
    return placed.join(sent_if_small(checkpointed(heavy)), F.col("_bucket") == F.col("_heavy"), "left").withColumn("_parts", most.cast("int")).drop("_heavy", "_items")


def merged(placed: DataFrame) -> DataFrame:
    """Rows (_key, _band, _bucket, _size) in which large buckets that overlap by half are one.

    A large group of near copies shares a bucket in each band, every time without those whose
    values there changed; one bucket for all of them holds each set once instead of once a band.
    """
    large = placed.where(F.col("_size") > BLOCK)
    if not large.limit(1).count():
        return placed
    own = large.select("_key", "_bucket", "_size").distinct()
    other = own.select("_key", F.col("_bucket").alias("_b"), F.col("_size").alias("_s"))
    overlaps = own.join(other, "_key").where("_bucket < _b").groupBy("_bucket", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min(F.least("_size", "_s")).alias("_least"))
    edges = overlaps.where("2 * _n >= _least").select(F.col("_bucket").alias("a"), F.col("_b").alias("b"))
    roots = components(edges).select(F.col("node").alias("_bucket"), "root")
    renamed = large.join(sent_if_small(roots), "_bucket", "left").select("_key", "_band", F.coalesce("root", "_bucket").alias("_bucket"))
    sizes = renamed.select("_key", "_bucket").distinct().groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    return placed.where(F.col("_size") <= BLOCK).unionByName(renamed.join(sent_if_small(checkpointed(sizes)), "_bucket").select("_key", "_band", "_bucket", "_size"))


def met(candidates: DataFrame, words: int, threshold: float) -> DataFrame:
    """_key, _links and _root of the sets that have links, from rows of ``places`` with their _text.

    A set goes to its buckets; in one of several parts, to all pairs of its part and another.
    """
    least = least_matches(threshold)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int, int] | None = None
        members: list[Member] = []
        found: list[tuple[bytes, int, bytes]] = []

        def batch_of() -> pa.RecordBatch:
            keys, links, roots = zip(*found, strict=True) if found else ((), (), ())
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(keys), pa.binary()), pa.array(list(links), pa.int64()), pa.array(list(roots), pa.binary())], names=["_key", "_links", "_root"])

        for batch in batches:
            for first, texts in text_slices(batch.column(8), 1 << 18):
                rows = zip(shingles(texts, words), *(c.slice(first, len(texts)).to_pylist() for c in batch.columns[:8]), strict=True)
                for items, bucket, i, j, part, key, weight, sig, own in rows:
                    if (bucket, i, j) != at:
                        if at and len(members) > 1:
                            found += block_links(members, at[0], at[1:], threshold, least)
                        at, members = (bucket, i, j), []
                    if key_of(items) == key:  # else another text under the same id
                        members.append(Member(key, weight, part, np.frombuffer(sig, np.uint32), np.array(own, np.int64), items))
            yield batch_of()
        if at and len(members) > 1:
            found += block_links(members, at[0], at[1:], threshold, least)
        yield batch_of()

    placed = in_parts(candidates).withColumn("_part", F.pmod(F.xxhash64("_key"), F.col("_parts")).cast("int"))
    paired = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    columns = ["_bucket", F.least("_part", "_other").alias("_i"), F.greatest("_part", "_other").alias("_j"), "_part", "_key", "_weight", "_sig", "_own", "_text"]
    dealt = paired.select(*columns).repartition("_bucket", "_i", "_j").sortWithinPartitions("_bucket", "_i", "_j")
    return in_arrow(dealt, meet, "_key binary, _links long, _root binary")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """id, class_id and n_links of each row.

    Two rows are linked if the Jaccard similarity of their sets of word shingles is at least
    ``threshold``; n_links counts all rows that a row is linked to, copies included. class_id is
    the smallest id of those reached over links. Rows without a word (null and empty texts too)
    have no link and are their own class. Rows that repeat an id are joined like others.

    Rows with equal sets become one before any of them meets another. Sets that share a band of
    MinHash values meet in buckets; buckets with the same members, and large ones that overlap by
    half, are one. A bucket is dealt in blocks of at most about ``BLOCK`` sets or ``BLOCK_ITEMS``
    shingles, so that no task holds more than two blocks, and what leaves a block is a row for
    each of its sets, not for each pair. Every pair of different sets of a bucket has to be
    counted, so a group of S near copies that differ costs S * S comparisons, and S * S / ``BLOCK``
    texts cross the exchange.
    """
    base = checkpointed(signed(docs, id_col, text_col, words))
    sets = base.where("_n > 0").groupBy("_key", "_n", "_sig").agg(F.min(F.struct("_id", "_hash")).alias("_first"), F.count(F.lit(1)).alias("_weight"))
    candidates = checkpointed(places(sets, band_rows(threshold)))
    texts = docs.select(F.col(id_col).alias("_of"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    # a row is found by its id and its text's hash, so that null and repeated ids bring no other texts along
    own = F.col("_first._id").eqNullSafe(F.col("_of")) & (F.col("_first._hash") == F.col("_hash"))
    # first, by these alone, to the texts that are needed
    needed = texts.join(sent_if_small(candidates.select("_first")), own, "left_semi")
    found = checkpointed(met(needed.join(candidates, own), words, threshold))
    links = found.groupBy("_key").agg(F.sum("_links").alias("_links"))
    roots = components(found.select(F.col("_key").alias("a"), F.col("_root").alias("b")))
    classes = (
        base.where("_n > 0").groupBy("_key").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_weight"))
        .join(links, "_key", "left")
        .join(roots.select(F.col("node").alias("_key"), F.col("root").alias("_root")), "_key", "left")
        .withColumn("_root", F.coalesce("_root", "_key"))
    )
    named = classes.groupBy("_root").agg(F.min("_first").alias("_class"))
    of_set = classes.join(named, "_root").select("_key", "_class", (F.col("_weight") - 1 + F.coalesce("_links", F.lit(0))).alias("_all"))
    return base.join(of_set.withColumnRenamed("_key", "_of"), (F.col("_key") == F.col("_of")) & (F.col("_n") > 0), "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("_of").isNull(), F.col("_id")).otherwise(F.col("_class")).alias("class_id"),
        F.coalesce("_all", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one_of_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all columns, of one document of each class: that of the smallest id.

    Rows of other classes are all kept. Rows with null ids are kept. Rows that repeat an id count
    as one document.
    """
    found = ngram_join(docs, id_col, text_col).where(F.col(id_col) > F.col("class_id")).select(F.col(id_col).alias("__ngram_join_drop"))
    return docs.join(sent_if_small(checkpointed(found)), F.col(id_col) == F.col("__ngram_join_drop"), "left_anti")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """class_id and n_links of every document, of five-word shingles at a similarity of 0.8; as of ``ngram_join``."""
    return ngram_join(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9
), r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a
), c AS (SELECT node, min(root) AS class_id FROM r GROUP BY node)
SELECT d.doc_id, class_id, (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links FROM documents d JOIN c ON c.node = d.doc_id
"""
