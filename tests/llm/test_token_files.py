import glob
import json
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import registry
from lodestone.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def test_registered_query(spark, documents, library, tmp_path):
    rows = [*documents, *documents[:5], (None, "no id"), (7000, "<|endoftext|> a<|startoftext|>"), (7001, "İSTANBUL ΑΣ ΣΑΣ é Å 日本語 ٣٤ ²½ \x00")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS _h", "2 AS _nth", "3 AS start").write.parquet(f"{tmp_path}/documents.parquet")
    df = registry.QUERIES["op12_token_files"](spark, str(tmp_path))
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and [t for _, t in df.dtypes] == ["bigint"] * 4
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[0])
    at = 0
    for (start, _, n, _), _ in zip(got, rows, strict=True):
        assert start == at
        at += n
    assert [k for _, k, _, _ in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    crc = lambda text: (len(library(text)), zlib.crc32(np.array(library(text), "<u4").tobytes()))
    assert sorted((k or -1, n, c) for _, k, n, c in got) == sorted((k or -1, *crc(t)) for k, t in rows)


def test_empty_table(spark, nothing, tmp_path):
    nothing.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    assert registry.QUERIES["op12_token_files"](spark, str(tmp_path)).count() == 0


def test_files_are_flat_and_mapped(spark, docs, documents, library, tmp_path):
    path = f"{tmp_path}/out"
    T.write_token_files(docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 5, "0"))), path, PATH)
    index = T.index_of(path)
    flat = b"".join(open(f"{path}/{p['name']}.ids", "rb").read() for p in index["parts"])
    own = [library(t) for _, t in documents]
    assert np.frombuffer(flat, "<u2").tolist() == [k for ids in own for k in ids]
    bases = np.cumsum([0, *[p["ids"] for p in index["parts"]]]).tolist()
    assert [p["base"] for p in index["parts"]] == bases[:-1] and bases[-1] == len(flat) // 2
    for p in index["parts"]:
        offsets = np.fromfile(f"{path}/{p['name']}.offsets", "<i8")
        assert len(offsets) == p["docs"] + 1 and offsets[0] == 0 and offsets[-1] == p["ids"]
    tokens = T.Tokens(path)
    assert len(tokens) == len(documents) and [x.tolist() for x in tokens] == own and isinstance(tokens[0], np.memmap)
    with pytest.raises(IndexError):
        tokens[len(documents)]
    # split into small tasks, the rows are the same
    rows = T.read_token_files(spark, path, split=500).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [f"d{k:05d}" for k, _ in documents] and [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == own
    assert T.read_token_files(spark, path, split=500).rdd.getNumPartitions() > len(index["parts"])


def test_a_hot_id_is_dealt_out(spark, tmp_path):
    rows = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("the same words again").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        T.write_token_files(rows, f"{tmp_path}/out", PATH, end=None)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = T.index_of(f"{tmp_path}/out")["parts"]
    assert sum(p["docs"] for p in parts) == 4000 and max(p["docs"] for p in parts) < 2000


def test_append_overwrite_and_failures(spark, tmp_path):
    path = f"{tmp_path}/out"
    one = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    two = spark.createDataFrame([(3, "d e f")], "doc_id long, text string")
    T.write_token_files(one, path, PATH)
    T.write_token_files(two, path, PATH, mode="append")
    ids = [x.tolist() for x in T.Tokens(path)]
    assert [len(x) for x in ids] == [3, 2, 4]
    before = json.load(open(f"{path}/index.json"))
    bad = spark.createDataFrame([(9, bytearray(np.array([70_000], "<u4").tobytes()))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="needs more than 2 bytes"):
        bad.write.format("token_files").option("path", path).option("width", "2").mode("overwrite").save()
    assert json.load(open(f"{path}/index.json")) == before and [x.tolist() for x in T.Tokens(path)] == ids
    with pytest.raises(Exception, match="ids of 2 bytes"):
        bad.write.format("token_files").option("path", path).option("width", "4").mode("append").save()
    T.write_token_files(two, path, PATH)
    assert [x.tolist() for x in T.Tokens(path)] == ids[2:]
    named = {f"{p['name']}.{k}" for p in T.index_of(path)["parts"] for k in ("ids", "offsets", "docs")}
    assert named <= {os.path.basename(p) for p in glob.glob(f"{path}/*")}
    with pytest.raises(Exception, match="doc_id and ids"):
        two.write.format("token_files").option("path", path).mode("overwrite").save()
    with pytest.raises(FileNotFoundError):
        T.Tokens(f"{tmp_path}/none")


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(T.WordTokenizer, "CHARS_KEPT", 5)
    own = T.WordTokenizer(PATH)
    for t in ["one two three", "three four", "", "one <|endoftext|>"] * 2:
        assert [x.tolist() for x in own.encode([t])] == [library(t)[:-1]]
