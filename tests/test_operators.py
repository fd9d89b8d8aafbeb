import pytest
from pyspark.sql import functions as F

from lodestone.functions.fixed import RELATIONSHIPS, REVIEW_STATES
from lodestone.operators import chunking as K
from lodestone.operators import coverage as C
from lodestone.operators import html as H
from lodestone.operators import joins as J
from lodestone.operators import vectors as W


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_outer_join_counts_each_total_once(spark):
    left = spark.createDataFrame([("a", 10.0), ("b", 5.0), (None, 1.0)], "k string, score double")
    right = spark.createDataFrame([("a", 2, 9.0), ("a", 1, 9.0), ("z", 1, 9.0), (None, 1, 9.0)], "k string, n int, score double")
    m = J.outer_with_origin(left, right, ["k"], [F.col("n").asc_nulls_last()])
    assert m.where("anchor").agg(F.sum("score")).first()[0] == 16.0
    assert m.where("has_left").agg(F.sum("score")).first()[0] == 26.0
    assert m.where("not has_left").count() == 2 and m.where("not has_detail").count() == 2
    assert rows(m.where("anchor and k = 'a'").select("n"), "n") == [(1,)]


def test_amend_is_idempotent(spark):
    base = spark.createDataFrame([(" a ", "x", "old"), ("b", "y", None)], "k string, f string, v string")
    changes = spark.createDataFrame([("a", "x", "new"), ("b", "y", None), ("c", "z", "lost")], "k string, f string, v string")
    inserts = spark.createDataFrame([("d", "w", "fresh"), ("b ", "y", "no")], "k string, f string, v string")
    once = J.amend(base, changes, inserts, ["k", "f"])
    assert sorted((r.k.strip(), r.v, r.outcome) for r in once.collect()) == [("a", "new", "applied"), ("b", None, "already"), ("c", "lost", "missing"), ("d", "fresh", "inserted")]
    again = J.amend(once.where("outcome <> 'missing'").drop("outcome"), changes, inserts, ["k", "f"])
    assert sorted(r.outcome for r in again.collect()) == ["already", "already", "kept", "missing"]
    assert rows(J.repeated_keys(changes.unionByName(changes.limit(1)), ["k", "f"]).select("n"), "n") == [(2,)]


def mapping(spark, *changed):
    clean = [(1, "OP-1", "f1", "S3", "305-1", "equivalent", "confirmed", ""), (2, "OP-1", "*", "S3", "305-2", "partial", "confirmed", "differs"), (3, None, None, "S3", "305-2", "gap_gri_side", "proposed", ""), (4, "OP-2", "f2", None, None, "gap_stars_side", "rejected", None)]
    return spark.createDataFrame([*clean, *changed], "line int, credit string, field string, standard string, disclosure string, relationship string, review_status string, caveat string")


@pytest.mark.parametrize("bad,rule", [
    ((9, "OP-1", "f1", "S3", "999-1", "equivalent", "confirmed", ""), "disclosure unknown"), ((9, "OP-1", "f1", "S4", "305-1", "equivalent", "confirmed", ""), "wrong standard"),
    ((9, "OP-1", "invented", "S3", "305-1", "equivalent", "confirmed", ""), "field unknown"), ((9, "ZZ-1", "f1", "S3", "305-1", "equivalent", "confirmed", ""), "credit unknown"),
    ((9, "OP-1", "f1", "S3", "305-1", "odd", "confirmed", ""), "unknown relationship"), ((9, "OP-1", "f1", "S3", "305-1", "component", None, ""), "unknown review status"),
    ((9, "OP-1", "f1", "S3", " ", "component", "confirmed", ""), "disclosure missing"), ((9, "", "f1", "S3", "305-1", "component", "confirmed", ""), "credit missing"),
    ((9, "OP-1", "f1", "S3", "305-1", "gap_gri_side", "confirmed", ""), "credit not allowed"), ((9, "OP-1", "f1", None, "305-1", "gap_stars_side", "confirmed", ""), "disclosure not allowed"),
    ((9, "OP-1", "f1", "S3", "305-1", "partial", "confirmed", " "), "warning: partial without caveat"),
])
def test_each_fabrication_is_found(spark, bad, rule):
    vocabulary = spark.createDataFrame([("S3", "305-1"), ("S3", "305-2")], "standard string, disclosure string")
    records = spark.createDataFrame([("OP-1", "f1"), ("OP-2", "f2"), ("OP-1", None)], "credit string, field string")
    check = lambda m: rows(J.violations(m, vocabulary, records, RELATIONSHIPS, REVIEW_STATES), "line")
    assert check(mapping(spark)) == []
    assert check(mapping(spark, bad)) == [(9, rule)]


def test_publishable(spark):
    assert J.publishable(mapping(spark)).count() == 1 and J.publishable(mapping(spark), include_partial=True).count() == 2
    with pytest.raises(Exception, match="no caveat"):
        J.publishable(mapping(spark, (9, "OP-1", "f1", "S3", "305-1", "partial", "confirmed", " ")), include_partial=True).select("line").collect()


def test_coverage_statuses(spark):
    vocabulary = spark.createDataFrame([("S", d) for d in "abcdefgh"], "standard string, disclosure string")
    m = spark.createDataFrame([
        ("a", "C", "f1", "equivalent", "confirmed"), ("b", "C", "f1", "partial", "confirmed"), ("c", "C", "f1", "equivalent", "confirmed"), ("c", None, None, "gap_gri_side", "confirmed"),
        ("d", "C", "blank", "component", "confirmed"), ("e", "C", "f1", "equivalent", "rejected"), ("f", "C", "f1", "equivalent", "proposed"), ("h", "C", "f1", "partial", "confirmed"), ("h", "C", "blank", "component", "confirmed"),
    ], "disclosure string, credit string, field string, relationship string, review_status string")
    records = spark.createDataFrame([("i", "C", "f1", "1"), ("i", "C", "blank", " ")], "entity string, credit string, field string, value string")
    entities = spark.createDataFrame([("i",)], "entity string")
    got = {r.disclosure: (r.status, r.values_available, r.citable, r.citable_strict) for r in C.coverage(vocabulary, m, entities, records).collect()}
    assert got == {
        "a": ("Reported", 1, True, True), "b": ("Partially reported", 1, False, False), "c": ("Not reported", 0, False, False), "d": ("Not reported", 0, False, False), "e": ("Not reported", 0, False, False),
        "f": ("Not reported", 0, False, False), "g": ("Not assessed", 0, False, False), "h": ("Reported", 1, True, False),
    }
    index = {r.disclosure: r.status for r in C.coverage(vocabulary, m, entities, records, proposed="Not assessed").collect()}
    assert index == {k: v[0] for k, v in got.items()} | {"f": "Not assessed"}


def spec_chunks(text, target=1000, overlap=200, least=120):
    """A statement of the packing in plain Python, to compare with."""
    import re

    out, cur = [], ""
    for p in [x.strip() for x in text.split("\n") if x.strip()]:
        pieces = [(s, " ") for s in re.split(r"(?<=[.!?])\s+", p)] if len(p) > target else [(p, "\n")]
        long = len(p) > target
        if long:
            out, cur = out + [cur.strip()] * (len(cur.strip()) >= least), ""
        for piece, sep in pieces:
            if cur and len(cur) + len(piece) + 1 > target:
                tail = "" if long else cur[-overlap:].strip()
                out, cur = out + [cur.strip()] * (len(cur.strip()) >= least), tail
            cur = (cur + sep + piece).strip()
        if long:
            out, cur = out + [cur.strip()] * (len(cur.strip()) >= least), ""
    return out + [cur.strip()] * (len(cur.strip()) >= least)


def test_chunks(spark):
    import random

    rng = random.Random(3)
    words = lambda n: " ".join("w" * rng.randrange(1, 9) for _ in range(n))
    texts = ["", "short", "x" * 1000, "x" * 119, "x" * 120, "x" * 1500, "a. " * 700, words(10) + "\n\n" + words(400), "\n".join(words(rng.randrange(1, 120)) + "." for _ in range(40)), words(20) + "\n" + ". ".join(words(30) for _ in range(20))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r.c for r in df.select("k", K.chunks(F.col("t")).alias("c")).orderBy("k").collect()]
    assert got == [spec_chunks(t) for t in texts]
    assert K.chunk_records(df.select("k", F.col("t").alias("text"))).where("chars < 120").count() == 0


def test_indexable(spark):
    df = spark.createDataFrame([(1, "same", ".pdf"), (2, "same", ".pdf"), (3, "same", ".xlsx"), (4, "y" * 200_001, ".pdf"), (5, "other", None)], "doc_id int, text string, extension string")
    assert rows(K.indexable(df).select("doc_id", "skipped"), "doc_id") == [(1, None), (2, "duplicate"), (3, "spreadsheet"), (4, "oversized"), (5, None)]


def index(spark):
    data = [
        (1, [1.0, 0.0], "knowledge", "", "framework", "en", False, ""), (2, [0.9, 0.1], "knowledge", "", "peer_report", "en", False, ""), (3, [0.9, 0.1], "knowledge", "", "framework", "fr", False, ""),
        (4, [0.5, 0.5], "knowledge", "", "framework", "en", True, ""), (5, [1.0, 0.0], "institution", "A", "document", "en", False, "E"), (6, [1.0, 0.1], "institution", "B", "document", "en", False, "E"), (7, [0.8, 0.2], "institution", "A", "document", "en", False, "S"),
    ]
    return spark.createDataFrame(data, "item_id int, vector array<double>, lane string, institution string, source_type string, language string, has_quantity boolean, pillar string")


def test_retrieval_is_safe(spark):
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query array<double>")
    found = lambda **k: [r.item_id for r in W.retrieve(queries, index(spark), **k).orderBy("rank").collect()]
    assert found() == [1, 4] and found(drop_quantities=True) == [1] and found(exclude_peer_reports=False) == [1, 2, 4]
    assert found(language=None) == [1, 3, 4] and found(min_score=0.9) == [1] and found(k=1) == [1]
    assert found(lane="institution", institution="A") == [5, 7] and found(lane="institution", institution="A", pillars=["S"]) == [7]
    assert set(found(lane="all", institution="A", k=3)) == {5, 7, 1}
    for bad in ({"lane": "institution"}, {"lane": "all"}, {"lane": "institution", "institution": "Z"}):
        with pytest.raises(W.LaneMisuse):
            found(**bad)
    with pytest.raises(ValueError):
        found(lane="other")


def test_headings_reset_sections_and_wells_serve_one_title(spark):
    html = "<nav><p>no</p></nav><h4>A</h4><h5>s</h5><p>one <b>bold</b> &amp; more<p>two</p><h4>B</h4><p>three<script>x</script></p>"
    pages = spark.createDataFrame([(1, html)], "k int, html string")
    found = H.events(pages, "k", "html", ("h4", "h5", "p"))
    got = rows(H.under_headings(found, "k", "h4", "h5").where("tag = 'p'").select("text", "heading", "section"), "text")
    assert got == [("one bold & more", "A", "s"), ("three", "B", None), ("two", "A", "s")]
    pairs = H.pair_titles(spark.createDataFrame([(1, 0, "t", "T1"), (1, 1, "t", "T2"), (1, 2, "w", "v"), (1, 3, "t", "T3")], "k int, ord int, tag string, text string"), "k", "t", "w")
    assert rows(pairs.select("title", "value"), "title") == [("T1", "v"), ("T2", None), ("T3", None)]
    table = spark.createDataFrame([(1, "<table><tr><th>a</th><td><a href='/report/x'>b</a></td></tr><tr><td>c<td>d</tr></table>")], "k int, html string")
    assert rows(H.table_rows(table, "k", "html"), "ord") == [(1, 0, "/report/x", "b", ["a", "b"]), (1, 1, "", "", ["c", "d"])]


def test_only_small_tables_are_sent(spark):
    from lodestone.functions.sizes import sent_if_small

    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hint(sent_if_small(spark.range(5), 5)) and not hint(sent_if_small(spark.range(5), 4))


def test_names_that_still_clash_are_an_error(spark):
    from lodestone.functions import text as T

    unique = lambda *rows: {(r.a, r.b): r.token for r in T.unique_slugs(spark.createDataFrame(rows, "g int, a string, b string"), ["g"], ["a", "b"]).collect()}
    long = "scope two emissions from off site sources of electricity, all of it, "
    got = unique((1, long, "market based"), (1, long, "location based"), (1, "x", "y"), (1, "x", "y"), (2, "x y", ""))
    assert len(set(got.values())) == 3 and got["x", "y"] == got["x y", ""] == "x_y" and all(len(v) <= 60 for v in got.values())
    assert unique((1, "a", None), (1, "a", None)) == {("a", None): "a"}
    for clash in [((1, "a", "b c"), (1, "a b", "c")), ((1, "a", None), (1, None, "a"))]:
        with pytest.raises(Exception, match="different names have one token"):
            unique(*clash)
    # a suffixed name that a third one has as its own
    token = got[long, "market based"]
    with pytest.raises(Exception, match="different names have one token"):
        unique((1, long, "market based"), (1, long, "location based"), (1, token, ""))
