"""Hard-negative mining: exact search within bands of score, filtered by means and deviations of vector segments."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import in_arrow
from lodestone.functions.stages import written
from lodestone.sources.tables import table

#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Positives of an anchor, negatives of a positive, and the band of negatives' scores in hundredths of the positive's.
POSITIVES, NEGATIVES, BAND = 5, 10, (30, 90)
#: Segments of a vector at each level of the filter, of which each level's divide those before.
LEVELS = (1, 4, 16)
#: Bytes of a block's vectors as doubles. Blocks meet in pairs, so smaller ones cost more exchange, larger ones more memory.
BLOCK_BYTES = 8_000_000
#: Rows and anchors that are scored at once, and the share of pairs below which they are followed one by one.
AT_ONCE, SPARSE = 1024, 1 / 8
#: Products below this are exact in doubles; those of larger vectors are added up as whole numbers of any size.
EXACT = 2.0**53

BLOCKS = "_block int, _rows binary, _ids binary, _labels binary, _anchors binary, _kind string, _vectors binary, _means binary, _deviations binary"


def edges(dim: int, parts: int) -> np.ndarray:
    """Where the segments of one level begin, and the end."""
    return np.arange(parts + 1) * dim // parts


def summary(vectors: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each segment, and its deviation: the length of what is left without the mean."""
    cut = edges(vectors.shape[1], parts)
    size = np.diff(cut)
    mean = np.add.reduceat(vectors, cut[:-1], axis=1) / size
    rest = vectors - np.repeat(mean, size, axis=1)
    return mean, np.sqrt(np.add.reduceat(rest * rest, cut[:-1], axis=1))


def levels_of(dim: int) -> list[int]:
    return [n for n in LEVELS if n <= dim]


@dataclass
class Vectors:
    """Rows of a block: their keys, ids, labels and vectors, and by level sqrt(size) * mean and deviation of each segment."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    norm: np.ndarray
    largest: float

    @classmethod
    def read(cls, row: dict) -> Vectors:
        ids = np.frombuffer(row["_ids"], np.int64)
        n = len(ids)
        vectors = np.frombuffer(row["_vectors"], row["_kind"]).reshape(n, -1).astype(np.float64)
        dim, levels = vectors.shape[1], []
        if known := levels_of(dim):
            mean, rest = (np.frombuffer(row[k], np.float32).reshape(n, -1).astype(np.float64) for k in ("_means", "_deviations"))
            size = np.diff(edges(dim, known[-1])).astype(np.float64)
            for parts in known:  # what is stored for the finest segments gives that of those they divide
                at = edges(known[-1], parts)[:-1]
                wide = np.add.reduceat(size, at)
                coarse = np.add.reduceat(mean * size, at, axis=1) / wide
                gap = mean - np.repeat(coarse, np.diff(np.append(at, known[-1])), axis=1)
                levels.append((np.sqrt(wide) * coarse, np.sqrt(np.add.reduceat(rest * rest + size * gap * gap, at, axis=1))))
        norm = np.sqrt((vectors * vectors).sum(axis=1))
        return cls(np.frombuffer(row["_rows"], np.int64), ids, np.frombuffer(row["_labels"], np.int64), vectors, levels, norm, float(np.abs(vectors).max(initial=0)))

    def __getitem__(self, at: np.ndarray) -> Vectors:
        return Vectors(self.rows[at], self.ids[at], self.labels[at], self.vectors[at], [(m[at], d[at]) for m, d in self.levels], self.norm[at], self.largest)


def whole(vectors: np.ndarray) -> np.ndarray:
    """The same numbers as Python's, of any size."""
    return np.array([[int(x) for x in row] for row in vectors.tolist()], object).reshape(vectors.shape)


def scores(anchors: Vectors, items: Vectors, low: np.ndarray, high: np.ndarray, apart: bool, seen: Callable[[int, int], None] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, item, score) of the pairs whose score is at least the anchor's ``low`` and at most its ``high``.

    Two segments' product is size * mean * mean within deviation * deviation, so sums over segments bound a
    score from both sides. Level by level, pairs go that can't be within; what is left is scored exactly. ``apart``: labels differ.
    A row never meets itself. ``seen`` is told how many pairs there were and how many were scored.
    """
    alive = anchors.rows[:, None] != items.rows[None, :]
    if apart:
        alive &= anchors.labels[:, None] != items.labels[None, :]
    pairs = int(alive.sum())
    if anchors.vectors.shape[1] * anchors.largest * items.largest >= EXACT:
        a, x = np.nonzero(alive)
        score = (whole(anchors.vectors)[a] * whole(items.vectors)[x]).sum(axis=1) if len(a) else np.zeros(0)
        good = np.array([lo <= s <= hi for s, lo, hi in zip(score, low[a], high[a], strict=True)], bool)
        return a[good], x[good], score[good]
    # the summaries are rounded to 24 bits
    low, high = low.astype(np.float64), high.astype(np.float64)
    slack = 1e-5 * anchors.norm * float(items.norm.max(initial=0)) + 1
    least, most = low - slack, high + slack
    a = x = None
    for (mean, rest), (mean_x, rest_x) in zip(anchors.levels, items.levels, strict=True):
        if a is None:
            centre, spread = mean @ mean_x.T, rest @ rest_x.T
            alive &= (centre + spread >= least[:, None]) & (centre - spread <= most[:, None])
            if alive.mean() < SPARSE:
                a, x = np.nonzero(alive)
        else:
            centre, spread = (mean[a] * mean_x[x]).sum(axis=1), (rest[a] * rest_x[x]).sum(axis=1)
            stay = (centre + spread >= least[a]) & (centre - spread <= most[a])
            a, x = a[stay], x[stay]
    if a is None:
        score = anchors.vectors @ items.vectors.T
        if seen:
            seen(pairs, int(alive.sum()))
        a, x = np.nonzero(alive & (score >= low[:, None]) & (score <= high[:, None]))
        return a, x, score[a, x]
    if seen:
        seen(pairs, len(a))
    score = (anchors.vectors[a] * items.vectors[x]).sum(axis=1)
    good = (score >= low[a]) & (score <= high[a])
    return a[good], x[good], score[good]


class Best:
    """The k best rows of each of n lists: the highest scores, ties by id."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.list, self.score = np.zeros(0, np.int64), np.zeros(0)
        self.ids, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, list_: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(list_):
            return
        list_, score = np.concatenate((self.list, list_)), np.concatenate((self.score, score))
        ids, rows = np.concatenate((self.ids, ids)), np.concatenate((self.rows, rows))
        if score.dtype == object:
            order = np.array(sorted(range(len(score)), key=lambda i: (list_[i], -score[i], ids[i], rows[i])), np.int64)
        else:
            order = np.lexsort((rows, ids, -score, list_))
        own = list_[order]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        nth = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
        keep = order[nth < self.k]
        self.list, self.score, self.ids, self.rows = list_[keep], score[keep], ids[keep], rows[keep]

    def worst(self) -> np.ndarray:
        """For each list its k-th score, or minus infinity while it has fewer."""
        out = np.full(self.n, -np.inf, self.score.dtype)
        counts = np.bincount(self.list, minlength=self.n)
        full = np.flatnonzero(counts == self.k)
        out[full] = self.score[np.cumsum(counts)[full] - 1]
        return out


def chunks(n: int) -> list[np.ndarray]:
    return [np.arange(a, min(n, a + AT_ONCE)) for a in range(0, n, AT_ONCE)]


def best_alike(anchors: Vectors, items: Vectors, k: int, seen: Callable | None = None) -> Iterator[tuple[np.ndarray, Best]]:
    """For the anchors of each label, and of so many at once: their places and the k best other rows of that label."""
    for label in np.intersect1d(anchors.labels, items.labels).tolist():
        own, others = np.flatnonzero(anchors.labels == label), items[np.flatnonzero(items.labels == label)]
        for part in chunks(len(own)):
            few, best = anchors[own[part]], Best(len(part), k)
            for at in chunks(len(others.ids)):
                some = others[at]
                a, x, score = scores(few, some, best.worst(), np.full(len(part), np.inf), False, seen)
                best.add(a, score, some.ids[x], some.rows[x])
            yield own[part], best


def best_in_bands(anchors: Vectors, items: Vectors, low: np.ndarray, high: np.ndarray, k: int, seen: Callable | None = None) -> Iterator[tuple[np.ndarray, Best]]:
    """For so many anchors at once: their places, and for each of their bands the k best rows of other labels in it.

    low, high: a row for each anchor, a column for each band, empty bands with low above high. List i * bands + j is anchor i's band j.
    """
    bands = low.shape[1]
    for part in chunks(len(anchors.ids)):
        few, lo, hi = anchors[part], low[part], high[part]
        best = Best(lo.size, k)
        empty = lo > hi
        for at in chunks(len(items.ids)):
            some = items[at]
            least = np.where(empty, np.inf, np.maximum(lo, best.worst().reshape(lo.shape)))
            a, x, score = scores(few, some, least.min(axis=1), np.where(empty, -np.inf, hi).max(axis=1), True, seen)
            for j in range(bands):
                good = (score >= least[a, j]) & (score <= hi[a, j])
                best.add(a[good] * bands + j, score[good], some.ids[x[good]], some.rows[x[good]])
        yield part, best


def packed(block: int, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """A row of ``BLOCKS``: vectors in the smallest type that holds them, and the finest segments' means and deviations."""
    largest = float(np.abs(vectors).max(initial=0))
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"
    mean, rest = summary(vectors, known[-1]) if (known := levels_of(vectors.shape[1])) else (np.zeros(0), np.zeros(0))
    with np.errstate(over="ignore"):
        raw = [rows.astype(np.int64), ids, labels, anchors.astype(bool), vectors.astype(kind), mean.astype(np.float32), rest.astype(np.float32)]
    cells = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in raw]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *cells[:4], pa.array([kind]), *cells[4:]], names=[f.split()[0] for f in BLOCKS.split(", ")])


def padded(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def in_blocks(rows: DataFrame, n: int, dim: int, scale: float | None) -> DataFrame:
    """``n`` blocks of rows (_row, _id, _label, _anchor, _vector), written once to the shared folder.

    With ``scale`` components become whole numbers and rows get a key: block and place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        got = [b for b in batches if len(b)]
        if not got:
            return
        whole_ = pa.Table.from_batches(got)
        column = lambda name: whole_.column(name).to_numpy()
        vectors = padded(whole_.column("_vector"), dim)
        keys = column("_row") if scale is None else (block << 32) + np.arange(len(whole_))
        yield packed(block, keys, column("_id"), column("_label"), column("_anchor"), vectors if scale is None else np.floor(scale * vectors))

    return written(in_arrow(rows.repartition(n), run, BLOCKS))


def anchors_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that are anchors."""
    for batch in batches:
        for row in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(row["_anchors"], bool))
            if len(at):
                got = Vectors.read(row)[at]
                vectors = pa.FixedSizeListArray.from_arrays(got.vectors.ravel(), got.vectors.shape[1]).cast(pa.list_(pa.float64())) if got.vectors.shape[1] else pa.array([[]] * len(at), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(got.rows), pa.array(got.ids), pa.array(got.labels), pa.array(np.ones(len(at), bool)), vectors], names=["_row", "_id", "_label", "_anchor", "_vector"])


def each_with_each(blocks: DataFrame, p: int, anchors: DataFrame, q: int, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` over each pair of a block and a block of anchors: p * q groups of one row on either side."""
    left = blocks.withColumn("_with", F.explode(F.sequence(F.lit(0), F.lit(q - 1)))).groupBy("_block", "_with")
    right = anchors.withColumnRenamed("_block", "_with").withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(p - 1)))).groupBy("_block", "_with")
    return left.cogroup(right).applyInArrow(run, schema)


def longs(values: np.ndarray) -> pa.Array:
    """Scores as longs; one that isn't a long is an error, not another number."""
    return pa.array([int(x) for x in values] if values.dtype == object else values.astype(np.int64), pa.int64())


def bands_of(positive: np.ndarray, band: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and the highest whole score s with band[0] * p <= 100 * s <= band[1] * p."""
    p = positive.astype(object)
    return -(-band[0] * p // 100), band[1] * p // 100


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int] = BAND, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: exact, over all rows.

    A score is the inner product of vectors whose components are floor(256 * x). An anchor's positives are its best
    ``positives`` other rows of its label; for each, the best ``negatives`` rows of other labels are returned whose score
    is between band[0] and band[1] hundredths of the positive's, ranked from 1. Ties go to the smaller id.

    Rows with a null id, label, vector or component, or one that isn't finite, take no part; a shorter vector ends in zeros.
    Rows that share an id are rows of their own: an anchor that is there twice gets its rows twice, and is its own twin's
    positive. A score beyond 64 bits is an error. Without rows or anchors there is no result.

    Rows are dealt into blocks of about ``block_bytes``, whatever their ids and labels, and each block meets each block of
    anchors in a task of its own, twice: for positives, then for negatives. At most ``positives`` rows of an anchor, or
    ``negatives`` of a positive, leave a pair of blocks.
    """
    number = F.col(id_col).cast("long")
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(number.isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.lit(None).cast("long").alias("_row"), number.alias("_id"), F.col(label_col).cast("long").alias("_label"), F.coalesce(is_anchor, F.lit(False)).alias("_anchor"), F.col(vector_col).cast("array<double>").alias("_vector")
    )
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_anchor").alias("anchors"), F.max(F.size("_vector")).alias("dim")).first()
    dim = size["dim"] or 0
    a_block = max(AT_ONCE, block_bytes // (8 * max(dim, 1)))
    p, q = max(1, ceil(size["rows"] / a_block)), max(1, ceil(size["anchors"] / a_block))
    blocks = in_blocks(rows, p, dim, SCALE)
    anchors = in_blocks(in_arrow(blocks, anchors_in, "_row long, _id long, _label long, _anchor boolean, _vector array<double>"), q, dim, None)

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for items in left.to_pylist():
            for block in right.to_pylist():
                own = Vectors.read(block)
                for at, best in best_alike(own, Vectors.read(items), positives):
                    of = at[best.list]
                    parts.append(pa.table([pa.array(np.full(len(of), block["_with"]), pa.int32()), pa.array(own.rows[of]), pa.array(best.ids), pa.array(best.rows), longs(best.score)], names=["_with", "_anchor", "_id", "_other", "_score"]))
        return pa.concat_tables(parts) if parts else pa.schema([("_with", pa.int32()), *((c, pa.int64()) for c in ("_anchor", "_id", "_other", "_score"))]).empty_table()

    best = Window.partitionBy("_anchor").orderBy(F.desc("_score"), "_id", "_other")
    found = each_with_each(blocks, p, anchors, q, find_positives, "_with int, _anchor long, _id long, _other long, _score long")
    chosen = found.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= positives)
    # as many as a block's anchors have, so they fit beside them
    with_positives = written(anchors.join(chosen.groupBy(F.col("_with").alias("_block")).agg(F.collect_list(F.struct("_anchor", "_nth", "_id", "_score")).alias("_positives")), "_block"))

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for items in left.to_pylist():
            for block in right.to_pylist():
                own, given = Vectors.read(block), block["_positives"]
                place = {k: n for n, k in enumerate(own.rows.tolist())}
                at = np.array([place[x["_anchor"]] for x in given], np.int64), np.array([x["_nth"] - 1 for x in given], np.int64)
                low, high = bands_of(np.array([x["_score"] for x in given], object), band)
                big = max(map(abs, [*low, *high])) >= EXACT
                lows, highs = np.full((len(own.ids), positives), np.inf, object if big else float), np.full((len(own.ids), positives), -np.inf, object if big else float)
                lows[at], highs[at] = low, high
                ids, score = np.zeros((2, len(own.ids), positives), np.int64)
                ids[at], score[at] = [x["_id"] for x in given], [x["_score"] for x in given]
                for part, best in best_in_bands(own, Vectors.read(items), lows, highs, negatives):
                    of, nth = part[best.list // positives], best.list % positives
                    columns = [own.rows[of], nth, own.ids[of], ids[of, nth], score[of, nth], best.ids, best.rows]
                    parts.append(pa.table([*map(pa.array, columns), longs(best.score)], names=names))
        return pa.concat_tables(parts) if parts else pa.schema([(c, pa.int64()) for c in names]).empty_table()

    names = ["_anchor", "_nth", "anchor_id", "positive_id", "positive_score", "negative_id", "_other", "negative_score"]
    order = Window.partitionBy("_anchor", "_nth").orderBy(F.desc("negative_score"), "negative_id", "_other")
    within = each_with_each(blocks, p, with_positives, q, find_negatives, ", ".join(f"{c} long" for c in names))
    return within.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor of ``embeddings`` (vec_id divisible by 100) and each of its five positives.

    Labels of rows whose vec_id is divisible by 7 go up by one, modulo 10, first. See ``hard_negatives`` for nulls, ties,
    repeated rows and empty tables.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""
