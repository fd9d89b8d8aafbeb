import re

import corpus_pipeline
from test_ngram_join import brute as classes


def test_stages(spark, documents, tmp_path):
    secret = "password=d48fd8e940a86f41832370bc4dd81bc9d95bf72b"
    rows = [(k, t, "en" if k % 3 else None, "src", len(t or "")) for k, t in documents] + [(900, f"a document with a {secret} in it", "en", "src", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "secret_scan", "packing"]
    step = df
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == df.columns, name
        kept.append({r.doc_id: r for r in step.collect()})
    letters = {r[0] for r in rows if re.search(r"[^\W\d_]", r[1] or "")}
    assert set(kept[0]) == letters
    norm = {}
    for k in sorted(letters):
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[k][1] if k < 900 else rows[-1][1]), k)
    assert set(kept[1]) == set(norm.values())
    assert set(kept[2]) == {c for c, _ in classes([(k, kept[1][k].text) for k in kept[1]]).values()}
    assert set(kept[3]) == set(kept[2])
    assert kept[3][900].text == "a document with a [assign] in it" and kept[3][900].n_chars == len(kept[3][900].text)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(kept[3])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
