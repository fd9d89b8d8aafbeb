"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import code_points, fold, in_arrow, text_slices
from lodestone.sources.tables import table

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Documents of each language that the counts are taken from, about; chosen by a hash of the id.
ROWS_PER_LANGUAGE = 20_000
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point, itself if it is a letter, else a space; built once in a worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)), np.uint32, 0x110000)
    return _letters


def features(texts: list[str], buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sparse rows in compressed form: bucket numbers for each order, where each text starts in
    them, and the number of letters of each text.

    Texts are lower-cased and all but letters read as spaces. An n-gram of spaces only, or one that
    crosses into another text, has the number ``buckets``, which weighs nothing.
    """
    lower = [t.lower() for t in texts]
    codes = letter_table()[code_points("\n".join(lower) + "\n" * max(orders))]
    sizes = np.fromiter((len(t) + 1 for t in lower), np.int64, len(lower))
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    n = int(sizes.sum())
    void = np.zeros(n + max(orders), bool)
    void[starts[1:] - 1] = True
    void[n - 1 :] = True
    blank = codes == 32
    letters = np.add.reduceat((~blank[:n]).astype(np.int64), starts)
    found = []
    for order in orders:
        mix = np.full(n, order * 0x632BE5AB & 0xFFFFFFFF, np.uint32)
        crosses, empty = void[:n].copy(), blank[:n].copy()
        for k in range(order):
            mix = (mix ^ codes[k : k + n]) * FACTORS[k % 4]
            mix ^= mix >> np.uint32(15)
            if k:
                crosses |= void[k : k + n]
                empty &= blank[k : k + n]
        index = (mix % np.uint32(buckets)).astype(np.int32)
        index[crosses | empty] = buckets
        found.append(index)
    return found, starts, letters


@dataclass
class LanguageModel:
    """weights: a row of log probabilities for each language, with a last column of zeros."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log joint probability of each text and language; the number of letters of each text."""
        found, starts, letters = features(texts, self.weights.shape[1] - 1)
        out = np.tile(self.prior, (len(texts), 1))
        for k, row in enumerate(self.weights):
            for index in found:
                out[:, k] += np.add.reduceat(row[index], starts)
        return out, letters


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Learn from rows with a language; about ``rows_per_language`` of each (all, if fewer).

    The bound is on what is learned from only; every text is scored. The counts reach the driver
    as at most ``BUCKETS`` sums for each language. Without any labelled row the model has no
    language, and everything is undetermined.
    """
    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    sizes = {r["_lang"]: r["n"] for r in labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((0, BUCKETS + 1)))
    scale = 1 << 20
    cut = F.create_map(*[F.lit(x) for k in languages for x in (k, min(scale, -(-rows_per_language * scale // sizes[k])))])
    sample = labelled.where(F.pmod(F.xxhash64("_id", F.lit("lang")), F.lit(scale)) < F.element_at(cut, F.col("_lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, texts in text_slices(batch.column(1)):
                by: dict[str, list[str]] = {}
                for k, t in enumerate(texts):
                    by.setdefault(names[first + k], []).append(t)
                for name, own in by.items():
                    total = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                    for index in features(own)[0]:
                        total += np.bincount(index, minlength=BUCKETS + 1)
        for name, total in sums.items():
            (at,) = np.nonzero(total[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["_lang", "_bucket", "_n"])

    counted = in_arrow(sample.select("_lang", "_text"), count, "_lang string, _bucket int, _n long")
    got = counted.groupBy("_lang", "_bucket").agg(F.sum("_n").alias("_n")).toArrow()
    counts = np.zeros((len(languages), BUCKETS))
    place = {k: i for i, k in enumerate(languages)}
    rows = np.fromiter((place[k] for k in got.column(0).to_pylist()), np.int64, got.num_rows)
    counts[rows, got.column(1).to_numpy()] = got.column(2).to_numpy()
    smooth = counts + 0.5
    weights = np.zeros((len(languages), BUCKETS + 1))
    weights[:, :BUCKETS] = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    share = np.array([sizes[k] for k in languages], float)
    return LanguageModel(languages, np.log(share / share.sum()), weights)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (posterior of that language) and n_letters of each row.

    A text that is null or has no letter is ``und`` with score 0; so is everything if the model
    knows no language. Texts of any length are read whole, in slices of bounded memory. The
    broadcast is (languages x buckets) doubles, whatever the size of the input.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            names, best, letters = [], [], []
            for _, texts in text_slices(batch.column(1)):
                if not known.languages:
                    own, n = np.zeros((len(texts), 1)), np.zeros(len(texts), np.int64)
                else:
                    own, n = known.scores(texts)
                top = own.argmax(axis=1)
                post = 1 / np.exp(own - own.max(axis=1, keepdims=True)).sum(axis=1)
                names += [known.languages[k] if m else "und" for k, m in zip(top.tolist(), n.tolist(), strict=True)]
                best.append(np.where(n > 0, post, 0.0))
                letters.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.concatenate([*best, np.zeros(0)])), pa.array(np.concatenate([*letters, np.zeros(0, np.int64)]))],
                names=[id_col, "lang_pred", "score", "n_letters"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), score, f"`{id_col}` {kind}, lang_pred string, score double, n_letters long")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all columns, whose text has a language of at least that posterior.

    Null and empty texts and texts without a letter go.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = [np.zeros(0, bool)]
            for _, texts in text_slices(batch.column(at)):
                if sent.value.languages:
                    own, letters = sent.value.scores(texts)
                    post = 1 / np.exp(own - own.max(axis=1, keepdims=True)).sum(axis=1)
                    stay.append((letters > 0) & (post >= least))
                else:
                    stay.append(np.array([any(map(str.isalpha, t)) for t in texts], bool))
            yield batch.filter(pa.array(np.concatenate(stay)))

    return in_arrow(docs, run, docs.schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out, lang_pred and score of every document, by naive Bayes learned outside the held-out fifth.

    Null and letterless texts are ``und`` with score 0; repeated rows are predicted alike, ties of languages
    go to the first in order; an empty table gives no row, and other columns are not read.
    """
    docs = table(spark, sf_dir, "documents")
    held = fold("doc_id", 5) == 0
    model = fit(docs.where(~held))
    return predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
