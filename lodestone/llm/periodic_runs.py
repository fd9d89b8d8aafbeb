"""Periodic runs of words, by suffix trees of a text and its reversal and Lyndon roots."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import MIX, in_arrow, mixed, text_slices
from lodestone.llm.packing import Places
from lodestone.sources.tables import table

#: A run has at least so many words and so many periods.
LEAST, PERIODS = 24, 3
#: Words of the pieces that have to recur. Up to (LEAST + 5) / 3 = 9, each such piece of a run recurs one period away within the run.
PIECE = 8
WORD = r"[^\x20\x09-\x0D]+"
_find_words = re.compile(WORD).findall
BLOCK = 16


class Tree:
    """Ukkonen's suffix tree of symbols from 1 on; the end of the text is symbol 0, smaller than all others."""

    def __init__(self, symbols: list[int], kinds: int):
        s = [*symbols, 0]
        self.size, self.kinds = len(s), kinds
        n = len(s)
        child: dict[int, int] = {}  # node * kinds + first symbol of the edge -> the node below
        start, depth, link = [0], [0], [0]
        self.suffix = suffix = [-1]  # of a leaf, where its suffix begins
        node = along = left = nodes = 0  # the active point is ``along`` symbols below node; ``left`` suffixes are not in the tree yet
        for i, c in enumerate(s):
            left += 1
            last = 0  # the node made last, whose suffix link is open
            while left:
                key = node * kinds + s[i - along]
                below = child.get(key)
                if below is None:
                    nodes += 1
                    child[key] = nodes
                    start.append(i)
                    depth.append(n - i + left - 1)
                    link.append(0)
                    suffix.append(i - left + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = depth[below] - depth[node]
                    if along >= span:
                        node = below
                        along -= span
                        continue
                    at = start[below]
                    if s[at + along] == c:
                        if last:
                            link[last] = node
                        along += 1
                        break
                    made = nodes + 1
                    nodes += 2
                    child[key] = made
                    start += (at, i)
                    depth += (depth[node] + along, n - i + left - 1)
                    link += (0, 0)
                    suffix += (-1, i - left + 1)
                    start[below] = at + along
                    child[made * kinds + s[at + along]] = below
                    child[made * kinds + c] = nodes
                    if last:
                        link[last] = made
                    last = made
                left -= 1
                if node:
                    node = link[node]
                elif along:
                    along -= 1
        self.depth = depth
        edges = np.fromiter(chain.from_iterable(child.items()), np.int64, 2 * len(child)).reshape(-1, 2)
        self.above, self.first, self.below = edges[:, 0] // kinds, edges[:, 0] % kinds, edges[:, 1]

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The Euler tour, shortened to the leaves and the visits between them.

        Returns the leaves' suffixes in the order of the symbols (or the opposite order, in which the end
        is the smallest symbol too), and for each leaf the depth of its lowest common ancestor with the one before.
        """
        order = np.lexsort((np.where(self.first > 0, -self.first if not descending else self.first, self.kinds), self.above))
        above, below = self.above[order], self.below[order]  # the last child in order comes first, for the stack
        nodes = len(self.depth)
        begin = np.searchsorted(above, np.arange(nodes + 1)).tolist()
        kids, depth, suffix = below.tolist(), self.depth, self.suffix
        leaves, gaps = [], []
        stack, gap = [0], [0]
        while stack:
            node, g = stack.pop(), gap.pop()
            a, b = begin[node], begin[node + 1]
            if a == b:
                leaves.append(suffix[node])
                gaps.append(g)
            else:
                stack += kids[a:b]
                gap += [depth[node]] * (b - a - 1)
                gap.append(g)
        return np.array(leaves, np.int64), np.array(gaps, np.int64)


class LowestBetween:
    """Minima of ranges, each in constant time: blocks of 16, and a table of doubled spans over the blocks."""

    def __init__(self, values: np.ndarray):
        rows = np.pad(values, (0, -len(values) % BLOCK), constant_values=np.iinfo(np.int64).max).reshape(-1, BLOCK)
        self.values = values
        self.upto = np.minimum.accumulate(rows, axis=1).ravel()
        self.since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.spans = [rows.min(axis=1)]
        while 2 ** len(self.spans) <= len(rows):
            k, last = 2 ** (len(self.spans) - 1), self.spans[-1]
            self.spans.append(np.minimum(last[:-k], last[k:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least values of the ranges from low to high, both included."""
        out = np.minimum(self.since[low], self.upto[high])
        a, b = low // BLOCK, high // BLOCK
        same = np.flatnonzero(a == b)
        least = self.values[low[same]]
        for k in range(1, BLOCK):
            least = np.minimum(least, self.values[np.minimum(low[same] + k, high[same])])
        out[same] = least
        wide = np.flatnonzero(b - a > 1)
        log = np.frexp((b - a - 1)[wide].astype(float))[1] - 1
        for level in np.unique(log).tolist():
            at = wide[log == level]
            row = self.spans[level]
            out[at] = np.minimum(out[at], np.minimum(row[a[at] + 1], row[b[at] - 2**level]))
        return out


class Extension:
    """Longest common extensions in constant time: the depth of two leaves' lowest common ancestor."""

    def __init__(self, tree: Tree):
        order, gaps = tree.tour()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.lowest = LowestBetween(gaps)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the suffixes from i and from j agree; i and j differ."""
        a, b = self.rank[i], self.rank[j]
        return self.lowest(np.minimum(a, b) + 1, np.maximum(a, b))


def next_smaller(rank: list[int]) -> list[int]:
    """For each suffix the next one, to its right, of lower rank: where its longest Lyndon word ends."""
    out, open_ = [0] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def runs_of(symbols: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """The runs (start, length, period) of a text of numbers, sorted by start, then period.

    Every run has the longest Lyndon word that begins at some place as its root, for the order of
    the symbols or for the opposite one. So each place and order gives one candidate; extended both ways
    by longest common extensions, it is a run if it is long enough. A root is primitive, so it is the least period.
    """
    own, code = np.unique(symbols, return_inverse=True)
    m, kinds = len(symbols), len(own) + 1
    text = (code + 1).tolist()
    tree = Tree(text, kinds)
    ahead = Extension(tree)
    back_order, _ = tree.tour(descending=True)
    opposite = np.empty(m + 1, np.int64)
    opposite[back_order] = np.arange(m + 1)
    del tree
    i = np.concatenate((np.arange(m), np.arange(m)))
    j = np.array(next_smaller(ahead.rank.tolist())[:m] + next_smaller(opposite.tolist())[:m], np.int64)
    near = (j - i) * periods <= m
    i, j = i[near], j[near]
    end = j + ahead(i, j)
    del ahead
    behind = Extension(Tree(text[::-1], kinds))
    begin = i - behind(m - i, m - j)
    length, period = end - begin, j - i
    good = length >= np.maximum(least, periods * period)
    return np.unique(np.stack((begin[good], period[good], length[good]), axis=1), axis=0)[:, [0, 2, 1]]


def recurring(words: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches of at least ``least`` words of which each piece of PIECE words is elsewhere in the same text, too.

    words: numbers of the words of several texts; text: the text of each. A run lies within one stretch: each of its
    pieces recurs one period away within the run. Pieces are told apart by a hash, so that now and then a
    stretch is longer than it need be.
    """
    n = len(words) - PIECE + 1
    if n < 1:
        return []
    each = mixed(words.astype(np.uint64) + np.uint64(1))
    piece = mixed(text[:n].astype(np.uint64) * MIX)
    for k in range(PIECE):
        piece = piece * np.uint64(0xD1342543DE82EF95) + each[k : n + k]
    order = np.argsort(piece)
    twin = piece[order[1:]] == piece[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][twin]] = again[order[:-1][twin]] = True
    again &= text[:n] == text[PIECE - 1 :]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], again, [False])).astype(np.int8)))
    begin, end = edges[0::2], edges[1::2] + PIECE - 1
    # neighbouring texts' stretches never touch: a text's last PIECE - 1 places begin no piece
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist(), strict=True))


def texts_runs(lists: list[list[str]]) -> list[np.ndarray]:
    """The runs of each text of a few."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    place = Places()
    words = np.fromiter(map(place.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(lists)), sizes)
    found: dict[int, list[np.ndarray]] = {}
    for a, b in recurring(words, text):
        k = int(text[a])
        found.setdefault(k, []).append(runs_of(words[a:b]) + np.array([a - begin[k], 0, 0]))
    return [np.concatenate(found[k]) if k in found else np.zeros((0, 3), np.int64) for k in range(len(lists))]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def described(words: list[str], runs: np.ndarray) -> tuple[str, str, tuple[int, int, int] | None]:
    """The runs as lines, the text without what they repeat, and the run of greatest length / period."""
    if not len(runs):
        return "", " ".join(words), None
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    rows = runs.tolist()
    best = rows[0]
    for r in rows[1:]:  # in order of start and period, so that ties stay with the first
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
    return "".join(f"{a},{n},{q}\n" for a, n, q in rows), " ".join([words[k] for k in kept]), tuple(best)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """id, n_runs, start, length, period, exponent_milli, runs, collapsed of each row.

    Words are maximal runs of anything but ASCII white space, numbered from 0. A run is a stretch
    of words whose least period q repeats at least three times over 24 words or more, and which no neighbouring word
    extends. ``runs`` has a line ``start,length,period`` for each; start to exponent_milli describe the one of greatest
    length / period (ties: smallest start, then period) and are null without any; ``collapsed`` is the text
    without what each run repeats. With ``digests``, runs_sha256 and collapsed_sha256 stand for both.

    Null text has no word; rows are independent, repeated ones and null ids included, and nothing is
    shuffled. Texts are taken whole; trees are built of those stretches alone whose every piece of eight
    words recurs in the text, which is true within any run, so that prose costs one sort. A tree
    takes some 400 bytes for each word of a stretch.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ("runs_sha256", "collapsed_sha256") if digests else ("runs", "collapsed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, best, lines, collapsed = [], [], [], []
            for _, texts in text_slices(batch.column(1)):
                lists = [_find_words(t) for t in texts]
                for words, runs in zip(lists, texts_runs(lists), strict=True):
                    a, b, top = described(words, runs)
                    count.append(len(runs))
                    best.append((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
                    lines.append(sha(a) if digests else a)
                    collapsed.append(sha(b) if digests else b)
            four = [pa.array([x[k] for x in best], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), *four, pa.array(lines, pa.string()), pa.array(collapsed, pa.string())], names=[id_col, "n_runs", "start", "length", "period", "exponent_milli", *names])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), run, f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, {names[0]} string, {names[1]} string")


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows; in those whose crc32 of the id as text ends in 0, a stretch of words goes on to the end over and over.

    With g that number without its last digit and n words, of which the first a = g % n stay, the next p = 1 + (n - a) div
    (3 + g % 8) are repeated up to n words. A null id or a text without words changes nothing.
    """
    hashed = F.crc32(F.col(id_col).cast("string"))
    chosen = docs.withColumns({"_g": F.floor(hashed / 10).cast("long"), "_words": F.when(hashed % 10 == 0, F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1)))})

    def of(words: Column, g: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")

    text = F.when(F.size("_words") > 0, of(F.col("_words"), F.col("_g"))).otherwise(F.col(text_col))
    return chosen.select(F.col(id_col), text.alias(text_col))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, after a tenth of the documents got repeated words (``with_repeats``).

    doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256. Null and empty
    texts have no run; repeated rows have a row each; an empty table gives no row.
    """
    return periodic_runs(with_repeats(table(spark, sf_dir, "documents")), digests=True)
