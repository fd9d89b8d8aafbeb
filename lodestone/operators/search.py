"""Exact search of vectors, block by block: a matrix product for each pair of blocks, of which only the best leave a task."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import fixed as X

#: Vectors of a block on either side; a task holds one of each, whatever their keys, as doubles.
ITEMS_AT_ONCE, QUERIES_AT_ONCE = 16_384, 4_096
#: Scores that a task holds at once.
SCORES_AT_ONCE = 2_000_000


def unit_rows(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of length 1, and which rows those are: null vectors, and those with a null or non-finite number, are left out. Shorter ones end in zeros."""
    column = column.combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    good = np.flatnonzero(np.isfinite(out).all(axis=1) & column.is_valid().to_numpy(zero_copy_only=False))
    out = out[good]
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), X.NORM_FLOOR), good


def widest(*columns: pa.ChunkedArray) -> int:
    return max([0, *(pc.max(pc.list_value_length(c)).as_py() or 0 for c in columns)])


def best_of_rows(scores: np.ndarray, k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of each row, ties by the lowest ``tie`` of a column; minus infinity is no score."""
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k, None]
        row, column = np.nonzero((scores >= least) & (scores > -np.inf))
    else:
        row, column = np.nonzero(scores > -np.inf)
    order = np.lexsort((tie[column], -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    return row[nth < k], column[nth < k]


def blocks_of(rows: DataFrame, n: int, other: int, own: str, across: str) -> DataFrame:
    """Rows with the number of their block, by a hash of what they hold, beside each block of the other side."""
    key = F.pmod(F.xxhash64(*rows.columns), F.lit(n)).cast("int")
    return rows.withColumn(own, key).withColumn(across, F.explode(F.sequence(F.lit(0), F.lit(other - 1))))


def best_in_blocks(
    queries: DataFrame, items: DataFrame, k: int, lane_k: dict[str, int] | None = None, apart: bool = False, min_score: float | None = None, digits: int | None = None, at_once: tuple[int, int] = (ITEMS_AT_ONCE, QUERIES_AT_ONCE)
) -> DataFrame:
    """(query_id, item_id, score), with ``lane_k`` and lane: of each pair of blocks, each query's k best items by cosine.

    queries: query_id, query (vector); items: item_id, vector, and lane if ``lane_k`` says how many each
    lane has (others: k). What the best of all are is for the caller to merge: see ``vectors.top_k``. ``apart``: an item of
    the query's own id doesn't count. ``min_score``: nor do lower scores. ``digits``: scores are rounded to so many places
    before they are compared, so that equal vectors tie whatever order a product was added up in.

    Both sides are dealt into blocks by a hash; each pair of blocks is a task of one matrix product. With n items, m queries
    and blocks of a and b of them, n * m * (1/a + 1/b) vectors cross the exchange, and k rows of a query for each
    block of items; no pair of vectors does. Null vectors, and those with a null or non-finite number, are never found.
    """
    sizes = items.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(queries.agg(F.count(F.lit(1)).alias("m")))).first()
    p, q = max(1, ceil(sizes["n"] / at_once[0])), max(1, ceil(sizes["m"] / at_once[1]))
    kinds = queries.schema["query_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    by_lane = lane_k is not None
    left = blocks_of(items.select("item_id", "vector", *(["lane"] if by_lane else [])), p, q, "_p", "_q")
    right = blocks_of(queries.select("query_id", "query"), q, p, "_q", "_p")
    schema = f"query_id {kinds[0]}, item_id {kinds[1]}, {'lane string, ' if by_lane else ''}score double"

    def search(found: pa.Table, asked: pa.Table) -> pa.Table:
        width = widest(found["vector"], asked["query"])
        x, at = unit_rows(found["vector"], width)
        y, asks = unit_rows(asked["query"], width)
        ids, names = found["item_id"].take(pa.array(at)), asked["query_id"].take(pa.array(asks))
        tie = np.empty(len(at), np.int64)
        tie[pc.sort_indices(ids).to_numpy()] = np.arange(len(at))
        if apart:
            kind = names.type if names.type == ids.type else pa.string()
            code = pa.chunked_array([*ids.cast(kind).chunks, *names.cast(kind).chunks], kind).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            own, other = code[len(at) :], code[: len(at)]
        lanes = found["lane"].take(pa.array(at)).to_pandas().to_numpy(object) if by_lane else np.zeros(len(at), object)
        parts = []
        for lane in dict.fromkeys(lanes.tolist()):
            most = lane_k.get(lane, k) if by_lane else k
            (members,) = np.nonzero([v == lane for v in lanes]) if by_lane else (np.arange(len(at)),)
            step = max(1, SCORES_AT_ONCE // max(1, len(members)))
            for a in range(0, len(asks), step) if most > 0 and len(members) else ():
                scores = y[a : a + step] @ x[members].T
                if digits is not None:
                    scores = np.round(scores, digits) + 0.0
                if apart:
                    scores[own[a : a + step, None] == other[None, members]] = -np.inf
                if min_score is not None:
                    scores[scores < min_score] = -np.inf
                row, column = best_of_rows(scores, most, tie[members])
                columns = [names.take(pa.array(row + a)), ids.take(pa.array(members[column]))] + ([pa.array([lane] * len(row), pa.string())] if by_lane else []) + [pa.array(scores[row, column])]
                parts.append(pa.table(columns, names=["query_id", "item_id", *(["lane"] if by_lane else []), "score"]))
        if not parts:
            empty = [names.slice(0, 0), ids.slice(0, 0)] + ([pa.array([], pa.string())] if by_lane else []) + [pa.array([], pa.float64())]
            return pa.table(empty, names=["query_id", "item_id", *(["lane"] if by_lane else []), "score"])
        return pa.concat_tables(parts)

    return left.groupBy("_p", "_q").cogroup(right.groupBy("_p", "_q")).applyInArrow(search, schema)
