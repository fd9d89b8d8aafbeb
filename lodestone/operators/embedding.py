"""Interchangeable embedders whose name an index records, and the search for candidate fields."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.nulls import is_populated
from lodestone.functions.sizes import sent_if_small
from lodestone.functions.stages import written
from lodestone.operators import vectors as W


class ModelEmbedder:
    """Dense vectors by a function from texts to rows, such as an ONNX session's; run in Arrow batches.

    load: called once in each worker, returns that function. Vectors get length 1.
    """

    def __init__(self, name: str, load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 32):
        self.name, self.load, self.batch = name, load, batch

    def encode(self, rows: DataFrame, key: str, text: str) -> DataFrame:
        load, size = self.load, self.batch
        kind = rows.schema[key].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                parts = [np.asarray(model(texts[k : k + size]), np.float32) for k in range(0, len(texts), size)]
                out = [v / max(float(np.linalg.norm(v)), 1e-12) for part in parts for v in part]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tolist() for v in out], pa.list_(pa.float32()))], names=[key, "vector"])

        return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, vector array<float>").withColumn("backend", F.lit(self.name))


class LexicalEmbedder:
    """TF-IDF behind the same interface: sparse vectors as maps from term to weight, fitted on a corpus."""

    name = "tfidf"

    def __init__(self, frequencies: DataFrame):
        self.frequencies = frequencies

    @classmethod
    def fit(cls, rows: DataFrame, key: str, text: str) -> LexicalEmbedder:
        return cls(written(W.document_frequencies(W.term_counts(rows, key, text), rows.count())))

    def encode(self, rows: DataFrame, key: str, text: str) -> DataFrame:
        weights = W.weights(W.term_counts(rows, key, text), self.frequencies, key)
        vectors = weights.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "w")))).alias("vector"))
        empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
        return rows.select(key).join(vectors, key, "left").select(key, F.coalesce("vector", empty).alias("vector"), F.lit(self.name).alias("backend"))


def first_available(choices: Sequence[Callable[[], ModelEmbedder | LexicalEmbedder]]) -> ModelEmbedder | LexicalEmbedder:
    """The first embedder that can be made here; why those before it can't is a warning.

    A choice is a function that raises ImportError or OSError if its library or model is missing.
    """
    for choice in choices:
        try:
            return choice()
        except (ImportError, OSError) as missing:
            warnings.warn(f"an embedder isn't available, the next is taken: {missing}", stacklevel=2)
    raise LookupError("no embedder is available")


class BackendMismatch(ValueError):
    """An index of one embedder searched with another."""


def check_backend(index: DataFrame, embedder: ModelEmbedder) -> DataFrame:
    """The index, if its rows are of this embedder."""
    names = [r[0] for r in index.select("backend").distinct().limit(2).collect()]
    if names and names != [embedder.name]:
        raise BackendMismatch(f"index of {names}, search by {embedder.name}")
    return index


def resolve_name(needle: str, names: dict[str, str]) -> str:
    """An institution's name by its key, or by a part that only one name has. names: key -> name."""
    low = needle.lower()
    found = [names[low]] if low in names else [n for n in names.values() if low in n.lower()]
    if len(found) != 1:
        raise LookupError(f"{needle!r} matches {len(found)} of {sorted(names.values())}")
    return found[0]


def field_corpus(records: DataFrame) -> DataFrame:
    """(credit, field, n_institutions, sample, text) of each field that someone populates; text is what is embedded."""
    rows = records.where(is_populated("value"))
    first = rows.groupBy("credit", "field").agg(F.countDistinct("institution").alias("n_institutions"), F.min_by(F.struct("credit_name", "value"), "ord").alias("_first"))
    return first.select("credit", "field", "n_institutions", F.substring("_first.value", 1, 200).alias("sample"), F.concat_ws(". ", "_first.credit_name", "field", F.substring("_first.value", 1, 300)).alias("text"))


def query_text(title: str = "title", text: str = "text") -> F.Column:
    return F.when(is_populated(text), F.concat_ws(". ", title, F.substring(text, 1, 600))).otherwise(F.col(title))


def targets(vocabulary: DataFrame, mapping: DataFrame, asked: list[str] | None = None, every: bool = False) -> DataFrame:
    """The disclosures to seek candidates for: those asked for by number, or all, or else those without any mapping row."""
    if asked is not None:
        return vocabulary.where(F.col("disclosure").isin(*asked))
    if every:
        return vocabulary
    mapped = mapping.select(F.trim("disclosure").alias("_mapped")).distinct()
    return vocabulary.join(sent_if_small(mapped), F.col("disclosure") == F.col("_mapped"), "left_anti")


def candidates(queries: DataFrame, fields: DataFrame, k: int = 6, min_score: float = 0.3, apart: bool = False, digits: int | None = None) -> DataFrame:
    """The k best fields for each query at or above a score, by blocks of either."""
    return W.nearest(queries, fields, k, min_score, apart, digits)
