"""A corpus pipeline over ``documents``: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, language_id, ngram_join, packing, secret_scan
from lodestone.llm.common import checkpointed, fold


def with_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a posterior of 0.5 or more. Null, empty and letterless texts go."""
    model = language_id.fit(docs.where(fold("doc_id", 5) != 0))
    return language_id.keep_identified(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, white space aside, the one of the smallest id."""
    return exact_dedup.keep_one_of_each(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similar ones link, five-word shingles and 0.8, the one of the smallest id."""
    return ngram_join.keep_one_of_class(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; each secret in a text reads as its kind in brackets, and n_chars follows."""
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of 2048: a row for each piece of a document."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", with_a_language),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: Neither the trained model nor the tokenizer can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each keeps is written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        docs = docs if k == len(STAGES) else checkpointed(docs)
    return docs
