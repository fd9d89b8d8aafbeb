"""Quality classifier: Bradley-Terry scores learned from preference pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.sizes import sent_if_small
from lodestone.llm.common import checkpointed, code_points, fold, in_arrow, text_slices, word_hashes
from lodestone.sources.tables import table

#: Steps at most, what holds weights small, and the parts of a range that scores are counted by: so many, from -FAR to FAR.
STEPS, DECAY, BINS, FAR = 40, 1e-3, 2_048, 32.0
#: Rows of features, of 2 KB, that a task of a pass takes, about.
ROWS_PER_TASK = 32_768
CLASSES = 8
TRIGRAMS = CLASSES**3
EXTRA = 8
FEATURES = TRIGRAMS + EXTRA
_classes: np.ndarray | None = None
_not_white: np.ndarray | None = None


def class_table() -> np.ndarray:
    """For each code point its class: space, line feed, lower, upper, digit, stop, stress, other."""
    global _classes, _not_white
    if _classes is None:
        kinds = np.full(0x110000, 7, np.uint8)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                kinds[c] = 3 if ch.isupper() else 2
            elif ch.isdecimal():
                kinds[c] = 4
            elif ch.isspace():
                kinds[c] = 0
        kinds[[ord(c) for c in ".,;:'\"-()"]] = 5
        kinds[[ord(c) for c in "!?"]] = 6
        kinds[10] = 1
        _classes, _not_white = kinds, kinds > 1
    return _classes


def features(texts: list[str]) -> np.ndarray:
    """A row of features for each text: shares of the trigrams of character classes, and how words
    are distributed (number, length, distinct, repeated at once, commonest). Of an empty text all are 0."""
    kinds = class_table()
    codes = kinds[code_points("\n".join(texts) + "\n\n\n")].astype(np.int64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts)), sizes)
    n = len(of)
    trigrams = (codes[:n] * CLASSES + codes[1 : n + 1]) * CLASSES + codes[2 : n + 2]
    inside = np.ones(n, bool)
    ends = np.cumsum(sizes)
    for back in (1, 2, 3):  # a trigram that reaches past its text, or begins with the line feed after it
        at = ends - back
        inside[at[at >= ends - sizes]] = False
    shares = np.bincount(of[inside] * TRIGRAMS + trigrams[inside], minlength=len(texts) * TRIGRAMS).reshape(len(texts), TRIGRAMS).astype(np.float32)
    shares /= np.maximum(sizes - 3, 1)[:, None]
    hashes, counts = word_hashes(texts, _not_white)
    of_word = np.repeat(np.arange(len(texts)), counts)
    total = np.maximum(counts, 1)
    order = np.lexsort((hashes, of_word))
    h, d = hashes[order], of_word[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    runs = np.diff(np.append(np.flatnonzero(fresh), len(h)))
    most = np.zeros(len(texts))
    np.maximum.at(most, d[fresh], runs)
    again = np.zeros(len(h), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    chars = sizes - 1
    extra = np.stack(
        [
            np.log1p(chars),
            np.log1p(counts),
            chars / total,
            np.bincount(d[fresh], minlength=len(texts)) / total,
            np.bincount(of_word[again], minlength=len(texts)) / total,
            most / total,
            np.log1p(most),
            (counts > 0) * 1.0,
        ],
        axis=1,
    )
    extra[chars == 0] = 0
    return np.concatenate([shares, extra.astype(np.float32)], axis=1)


@dataclass
class Ranking:
    """A linear score of standardised features; cut is its threshold and spread its unit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the threshold."""
        return 1 / (1 + np.exp(-np.clip((self.raw(rows) - self.cut) / self.spread, -30, 30)))


#: What a pass over all labelled rows does: it gives f(rows, better) summed over blocks of them.
Passes = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def binned(s: np.ndarray, low: float, high: float) -> np.ndarray:
    """How many values each of ``BINS`` equal parts of a range has; what is outside counts at its ends."""
    at = np.clip(((s - low) * (BINS / (high - low))).astype(np.int64), 0, BINS - 1)
    return np.bincount(at, minlength=BINS)


def by_class(s: np.ndarray, better: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.concatenate([binned(s[~better], low, high), binned(s[better], low, high)])


def shared(s: np.ndarray, better: np.ndarray) -> np.ndarray:
    """How much of the values of each class is at each of ``BINS`` points from -FAR to FAR; a value is shared by the two beside it, so that sums go smoothly with it."""
    at = np.clip((s + FAR) * ((BINS - 1) / (2 * FAR)), 0, BINS - 1.000001)
    k = at.astype(np.int64)
    count = lambda own: np.bincount(k[own], 1 - (at - k)[own], BINS) + np.bincount(k[own] + 1, (at - k)[own], BINS)
    return np.concatenate([count(~better), count(better)])


def learn(total: Passes, width: int, share: float | None = None) -> Ranking:
    """Learn scores such that P(a is preferred to b) = sigmoid(score a - score b), of every pair of a better and a worse document.

    The loss is the mean logistic loss on the difference of all pairs' scores. Each document is set against how many of the other
    class have which score, so a step takes two passes, however many pairs there are. The threshold is the quantile of all
    scores above which ``share`` of documents lies, classes weighted to it; by default the share of better ones.
    """
    sums = total(lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
    n, good = sums[0], sums[1]
    if not n:
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    mean = sums[2 : 2 + width] / n
    scale = np.maximum(np.sqrt(np.maximum(sums[2 + width :] / n - mean * mean, 0)) + 1e-6, 1e-3 * np.maximum(1, np.abs(mean)))
    if not good or good == n:
        return Ranking(mean, scale, np.zeros(width), 0.0, 1.0)
    share = good / n if share is None else share
    unit = lambda x: np.clip((x - mean) / scale, -8, 8)
    step = 2 * FAR / (BINS - 1)
    gaps = step * np.arange(1 - BINS, BINS)
    points = step * np.arange(BINS) - FAR

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        counts = total(lambda x, y: shared(unit(x) @ w, y)).reshape(2, BINS) / np.array([[n - good], [good]])
        pairs = np.convolve(counts[1], counts[0][::-1])
        return float(np.maximum(pairs, 0) @ np.logaddexp(0, -gaps) + DECAY / 2 * (w @ w)), counts

    def slope(w: np.ndarray, counts: np.ndarray) -> np.ndarray:
        rise = 1 / (1 + np.exp(np.clip(points[:, None] - points[None, :], -30, 30)))
        # at a better one's score: how likely each worse one is preferred; at a worse one's: how likely it is to a better one
        better_pull, worse_pull = rise @ counts[0], rise.T @ counts[1]

        def pulls(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = unit(x)
            s = np.clip(z @ w, points[0], points[-1])
            return z.T @ np.where(y, -np.interp(s, points, better_pull) / good, np.interp(s, points, worse_pull) / (n - good))

        return total(pulls) + DECAY * w

    w = np.zeros(width)
    at, counts = loss(w)
    g = slope(w, counts)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        d, undone = -g, []
        for s, y in reversed(moves):
            k = (s @ d) / (s @ y)
            d = d - k * y
            undone.append(k)
        d = d * ((moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, float(np.linalg.norm(g))))
        for (s, y), k in zip(moves, reversed(undone)):
            d = d + s * (k - (y @ d) / (s @ y))
        for size in (1.0, 0.3, 0.1, 0.03):
            tried, tried_counts = loss(w + size * d)
            if tried <= at + 1e-4 * size * (g @ d):
                break
        else:
            break
        after = slope(w + size * d, tried_counts)
        if size * d @ (after - g) > 1e-12:
            moves = [*moves[-9:], (size * d, after - g)]
        gained, w, at, g = at - tried, w + size * d, tried, after
        if gained < 1e-7 * at:
            break
    raw = lambda x: unit(x) @ w
    spread = total(lambda x, y: np.array([raw(x).sum(), (raw(x) ** 2).sum()])) / n
    # the score that the quantile parts, narrowed to one in BINS at a time until two neighbours are apart
    low, high, weight = -8 * np.abs(w).sum() - 1, 8 * np.abs(w).sum() + 1, np.array([(1 - share) / (n - good), share / good])
    for _ in range(4):
        width_of = (high - low) / BINS
        upto = np.cumsum(weight @ total(lambda x, y, a=low, b=high: by_class(raw(x), y, a, b)).reshape(2, BINS))
        k = min(int(np.searchsorted(upto, 1 - share - 1e-12)), BINS - 1)
        nearer = (low + k * width_of, low + (k + 1) * width_of)
        empty = int(np.searchsorted(upto, upto[k], side="right")) - k - 1
        if upto[k] <= 1 - share + 1e-12:  # the parts end here: halfway to the next that has scores
            low = high = nearer[1] + min(empty, BINS - 1 - k) * width_of / 2
            break
        low, high = nearer
    return Ranking(mean, scale, w, float((low + high) / 2), float(np.sqrt(max(0.0, spread[1] - spread[0] ** 2)) / 4 + 1e-6))


def rank(rows: np.ndarray, better: np.ndarray, share: float) -> Ranking:
    """What all pairs of better and worse rows of an array teach; see ``learn``."""
    return learn(lambda f: f(rows, better), rows.shape[1], share)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Learn from every document whose label is 0 or 1.

    Documents with labels of both kinds, and labels without a document, are left out. Features are made once and written;
    each pass over them sends sums to the driver, a few KB a task: see ``learn``. Ids of up to a million labels are broadcast.
    """
    clear = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_of")).agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_z")).where("_y = _z")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(sent_if_small(clear.select("_of", "_y")), F.col("_id") == F.col("_of")).select("_y", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, own in text_slices(batch.column(1)):
                rows = [r.tobytes() for r in features(own)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(own)).cast(pa.int32()), pa.array(rows, pa.binary())], names=["_y", "_row"])

    made = checkpointed(in_arrow(texts, run, "_y int, _row binary"))
    made = made.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, made.count() // ROWS_PER_TASK))

    def total(f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for batch in batches:
                rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, FEATURES).astype(np.float64)
                part = f(rows, batch.column(0).to_numpy(zero_copy_only=False) == 1)
                out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([np.asarray(out, np.float64).tobytes()], pa.binary())], names=["_sum"])

        parts = [np.frombuffer(r[0], np.float64) for r in made.mapInArrow(run, "_sum binary").collect()]
        return np.sum(parts, axis=0) if parts else f(np.zeros((0, FEATURES)), np.zeros(0, bool)).astype(np.float64)

    return learn(total, FEATURES)


def score(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of each row; null text reads as empty, which has a score too.

    Without labels of both classes every score is 0.5. Rows are independent; nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.scores(features(texts)) for _, texts in text_slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*found, np.zeros(0)]))], names=[id_col, "score"])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), run, f"`{id_col}` {kind}, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out, score and predicted of every document, ranked by what was learned outside the held-out third.

    Null reads as empty, which has a score; repeated rows score alike; an empty table gives no row.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(fold("doc_id", 3) != 1))
    return score(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
