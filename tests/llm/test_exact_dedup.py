import hashlib
import re
from collections import defaultdict

from lodestone.llm.exact_dedup import exact_dedup, keep_one_of_each, op7_exact_dedup


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for k, t in rows:
        groups[norm(t)].append(k)
    return {(k, min(groups[norm(t)]), len(groups[norm(t)]), k == min(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for k, t in rows}


def test_matches_brute_force(docs, documents):
    got = exact_dedup(docs).collect()
    assert len(got) == len(documents)
    assert {tuple(r) for r in got} == brute(documents)


def test_hot_group_and_repeated_rows(spark):
    rows = [(k, "same text") for k in range(500)] + [(3, "same text"), (None, "same  text"), (7, "other"), (7, "other")]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == 2
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 502), (7, 2)}


def test_whole_rows_that_stay(docs, documents):
    out = keep_one_of_each(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(r.doc_id for r in got) == sorted({r[1] for r in brute(documents)})
    texts = dict(documents)
    assert all(r.text == texts[r.doc_id] for r in got)


def test_repeated_rows_stay_once(spark):
    rows = [(2, "a b"), (2, "a b"), (None, "c"), (None, "c"), (1, "a  b"), (5, None), (4, "")]
    got = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got if r.doc_id is not None) == [(False, 1, "a  b"), (False, 4, "")]
    assert len(got) == 3


def test_empty_table(nothing):
    assert exact_dedup(nothing).count() == 0
    assert keep_one_of_each(nothing).count() == 0


def test_query_on_a_table(spark, documents, tmp_path):
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op7_exact_dedup(spark, str(tmp_path))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = got.collect()
    assert {tuple(r) for r in rows} == brute(documents) and len(rows) == len(documents)


def test_a_hot_group_goes_back_to_its_rows_by_salts(spark):
    rows = [(k, "same text") for k in range(400)] + [(k, f"text {k}") for k in range(400, 500)]
    plan = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), salts=8)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(_sha") >= 2 and "hashpartitioning(_named" in text
    joins = [x for x in text.splitlines() if "Join" in x]
    assert joins and all("_salt" in x and "_of" in x for x in joins)
    assert len(plan.collect()) == 500
