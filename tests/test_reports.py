import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import embedding as E
from lodestone.operators import measures as M
from lodestone.operators import narrative as N
from lodestone.operators import requirements as R
from lodestone.sources import config as C

REFERENCES = T.reference_pattern(["305-1", "2-9"])


def test_strongest_link_and_metrics(spark):
    mapping = spark.createDataFrame([(1, "C", "f", "S", "d1", "partial", "confirmed"), (2, "C ", "f", "S", "d2", "equivalent", "confirmed"), (3, "C", "f", "S", "d3", "equivalent", "confirmed"), (4, "C", "g", "S", "d4", "equivalent", "proposed")], "line int, credit string, field string, standard string, disclosure string, relationship string, review_status string")
    assert [tuple(r) for r in M.strongest_links(mapping).collect()] == [("C", "f", "S", "d2", "equivalent")]
    rows = [("i", "C", "f", "number", 1.0), ("j", "C", "f", "number", 2.0), ("i", "C", "g per Person", "number", 3.0), ("i", "C", "Points earned x", "number", 1.0), ("i", "C", "t", "text", None), ("i", "C", "n", "number", None)]
    master = spark.createDataFrame(rows, "institution string, credit string, field string, value_type string, value_numeric double")
    got = {(r.institution, r.field): r for r in M.metrics(master, mapping, 2, notes=[(F.col("institution") == "j", "first"), (F.col("value_numeric") > 1, "second")]).collect()}
    assert set(got) == {("i", "f"), ("j", "f"), ("i", "g per Person")}
    assert got["i", "f"].disclosure == "d2" and got["i", "f"].comparable and not got["i", "f"].is_intensity and got["i", "f"].data_quality is None
    assert got["j", "f"].data_quality == "first" and got["i", "g per Person"].data_quality == "second" and got["i", "g per Person"].is_intensity and not got["i", "g per Person"].comparable


def world(spark):
    sections = spark.createDataFrame([("s", "d1"), ("s", "d2"), ("s", "d3")], "section string, disclosure string")
    mapping = spark.createDataFrame([
        (1, "OP-1", "Use", "d1", "equivalent", "confirmed", "", "Differs by 5 from GRI 305-1"), (2, "OP-1", "Prose", "d1", "component", "confirmed", "", None), (3, "OP-1", "Blank", "d2", "component", "confirmed", "", "unused"),
        (4, None, None, "d3", "gap_gri_side", "confirmed", "No data; others have 45", None), (5, "OP-1", "Use", "d3", "equivalent", "confirmed", "", None), (6, "OP-1", "Use", "d2", "equivalent", "proposed", "", None),
    ], "line int, credit string, field string, disclosure string, relationship string, review_status string, rationale string, caveat string")
    records = spark.createDataFrame([("A", "OP-1", "Use", "1,200", "kg", "number"), ("A", "OP-1", "Prose", "x" * 700, "", "text_long"), ("A", "OP-1", "Blank", " ", "", "text")], "entity string, credit string, field string, value string, units string, value_type string")
    return sections, mapping, records


def test_facts_prompts_and_audit(spark):
    found = N.facts(*world(spark), REFERENCES)
    got = sorted((r.kind, r.disclosure, r.field, r.token, r.text and r.text[:30]) for r in found.collect())
    assert got == [
        ("caveat", "d1", "Use", None, "Differs by [figure] from GRI 3"), ("context", "d1", "Prose", None, "x" * 30), ("figure", "d1", "Use", "op_1_use", "1,200 kg"),
        ("gap", "d3", None, None, "No data; others have [figure]"), ("unavailable", "d2", "Blank", None, None),
    ]
    assert len(found.where("kind = 'context'").first().text) == 604
    asked = N.prompts(found, spark.createDataFrame([("s", "Title")], "section string, title string")).first()
    assert "{{ op_1_use }}" in asked.prompt and "1,200" not in asked.prompt and asked.prompt.startswith("# Title — A\nFIGURE")
    for name, writer in N.WRITERS.items():
        template = writer().write("system", asked.prompt, ["op_1_use"])
        row = spark.createDataFrame([(template, {"op_1_use": "1,200 kg"}, ["source text"])], "template string, figures map<string,string>, context array<string>")
        done = N.finished(row, REFERENCES).first()
        assert done.publishable == (name == "stub"), done
        assert done.ok == (["1,200"] if name == "stub" else []) and done.invented == ([] if name == "stub" else ["19", "31,337"])


def test_cache_and_gate(spark):
    asked = spark.createDataFrame([("A", "s", "p1"), ("A", "t", "p2")], "entity string, section string, prompt string")
    key = asked.select(N.cache_key(F.lit("sys"), F.col("prompt"))).first()[0]
    hit, miss = N.to_write(asked, spark.createDataFrame([(key, "prose", "m")], "key string, prose string, model string"), "sys")
    assert [r.section for r in hit.collect()] == ["s"] and [r.section for r in miss.collect()] == ["t"]
    sections, vocabulary = C.outline(spark, {"s": ("Title", ["d1", "dx"])}), spark.createDataFrame([("d1",), ("d2",)], "disclosure string")
    assert sorted(tuple(r) for r in N.missing_disclosures(sections, vocabulary).collect()) == [("d2", "right"), ("dx", "left")]


def test_prompts_of_one_key_are_told_apart(spark):
    # SHA-256 of "system", a zero and either prompt begins with the same 32 bits
    asked = spark.createDataFrame([(1, "prompt 1059"), (2, "prompt 4053")], "k int, prompt string").withColumn("_key", N.cache_key(F.lit("system"), F.col("prompt")))
    (key,) = {r[0] for r in asked.select("_key").collect()}
    columns = "key string, prose string, model string, prompt_sha256 string"
    own = (key, "own", "m", hashlib.sha256(b"prompt 1059").hexdigest())
    for rows, had in (([own], [(1, "own")]), ([own, (key, "bare", "m", None)], [(1, "own")]), ([(key, "bare", "m", None)], [(1, "bare"), (2, "bare")])):
        hit, miss = N.to_write(asked.drop("_key"), spark.createDataFrame(rows, columns), "system")
        assert sorted((r.k, r.prose) for r in hit.collect()) == had and {r.k for r in miss.collect()} == {1, 2} - {k for k, _ in had}


def test_facts_meet_entities_once(spark, monkeypatch):
    """A mapping that says the same on many lines makes no more rows than one that says it once."""
    sections = spark.createDataFrame([("s", "d1"), ("s", "d2")], "section string, disclosure string")
    mapping = spark.range(3000).select(
        F.col("id").alias("line"), F.lit("C").alias("credit"), F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("field"), F.when(F.col("id") % 10 == 9, "d2").otherwise("d1").alias("disclosure"),
        F.when(F.col("id") % 10 == 9, "gap_gri_side").otherwise("equivalent").alias("relationship"), F.lit("confirmed").alias("review_status"), F.concat(F.lit("why "), (F.lit(5000) - F.col("id")).cast("string")).alias("rationale"), F.lit(None).cast("string").alias("caveat"),
    )
    records = spark.createDataFrame([(e, "C", f, "1", "kg", "number") for e in ("a", "b") for f in ("f0", "f1")], "entity string, credit string, field string, value string, units string, value_type string")
    named, sizes = T.unique_slugs, []
    monkeypatch.setattr(T, "unique_slugs", lambda rows, *more: (sizes.append(rows.count()), named(rows, *more))[1])
    found = N.facts(sections, mapping, records, T.reference_pattern(["305-1"])).collect()
    expected = [(e, k, f) for e in ("a", "b") for k, f in (("figure", "f0"), ("figure", "f1"), ("unavailable", "f2"), ("gap", ""))]
    assert sorted((r.entity, r.kind, r.field or "") for r in found) == sorted(expected) and sizes == [4]
    # a gap's first line says why
    assert {r.text for r in found if r.kind == "gap"} == {"why [figure]"}


def test_requirements(spark):
    html = "<nav><h2>305-9 no</h2></nav><h2>Disclosure 305-1 Direct emissions</h2><p>Report CO<sub>2</sub>:</p><ul><li>a<li>b</ul><h3>Guidance to it</h3><p>no</p><h2>Background</h2><p>no</p><h2>2-9 Other</h2><p>c</p><h2>305-1 Again</h2><p>d</p>"
    got = R.extract_requirements(spark.createDataFrame([(1, html)], "k int, html string"), "k", "html")
    assert sorted((r.number, r.title, r.text) for r in got.collect()) == [("2-9", "Other", "c"), ("305-1", "Direct emissions", "Report CO2:\na\nb")]


def test_embedders(spark):
    embed = E.ModelEmbedder("lengths", lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]), batch=2)
    rows = spark.createDataFrame([(1, "abc"), (2, None), (3, "a")], "id int, text string")
    index = embed.encode(rows, "id", "text")
    got = {r.id: r.vector for r in index.collect()}
    assert got[2] == [0.0, 1.0] and np.isclose(np.linalg.norm(got[1]), 1, atol=1e-6)
    assert E.check_backend(index, embed) is index
    with pytest.raises(E.BackendMismatch):
        E.check_backend(index, E.ModelEmbedder("other", lambda: None))
    names = {"a": "University of A", "tu": "Technical College"}
    assert E.resolve_name("TU", names) == "Technical College" and E.resolve_name("versity", names) == "University of A"
    with pytest.raises(LookupError):
        E.resolve_name("e", names)
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "query_id int, query array<double>")
    fields = index.select(F.col("id").alias("item_id"), "vector")
    assert [r.item_id for r in E.candidates(queries, fields, k=2, min_score=0.5).orderBy("rank").collect()] == [1, 3]
    texts = spark.createDataFrame([("T", "body"), ("T", None)], "title string, text string").select(E.query_text())
    assert [r[0] for r in texts.collect()] == ["T. body", "T"]


def test_config(spark):
    known = [C.Institution("a", "Univ A", "3.0")]
    assert C.institutions(spark, known).first().stars_version == "3.0" and known[0].path("/lake", "scores.csv") == "/lake/a/scores.csv"
    got = spark.createDataFrame([("x",), ("y",)], "s string").select(C.looked_up(F.col("s"), {"x": "framework"}, "context"))
    assert [r[0] for r in got.collect()] == ["framework", "context"]


def test_figures_carry_their_units(spark):
    from lodestone.functions import text as T
    from lodestone.operators import narrative as N

    sections = spark.createDataFrame([("s", "1-1")], "section string, disclosure string")
    fields = [("Energy use", "5", "MWh"), ("Percentage of employees trained", "96.20", None), ("Number of weeks of paid leave", "26", ""), ("Head count", "12", None)]
    mapping = spark.createDataFrame([(k, "1-1", "C", f, "component", "confirmed", "", None) for k, (f, _, _) in enumerate(fields)], "line int, disclosure string, credit string, field string, relationship string, review_status string, rationale string, caveat string")
    records = spark.createDataFrame([("e", "C", f, v, u, "number") for f, v, u in fields], "entity string, credit string, field string, value string, units string, value_type string")
    got = {r.field: r.text for r in N.facts(sections, mapping, records, T.reference_pattern(["1-1"])).collect() if r.kind == "figure"}
    assert got == {"Energy use": "5 MWh", "Percentage of employees trained": "96.20%", "Number of weeks of paid leave": "26 weeks", "Head count": "12"}


def test_passages_are_the_institutions_own_and_blanked(spark):
    from lodestone.functions import text as T
    from lodestone.operators import narrative as N

    rows = [("a", [1.0, 0.0], "institution", "U", "report", "en", True, "", "own", "We used 15 tons."), ("b", [1.0, 0.0], "institution", "V", "report", "en", False, "", "other", "Not ours."),
            ("c", [1.0, 0.1], "knowledge", "", "framework", "en", False, "", "guide", "Write plainly."), ("d", [0.0, 1.0], "knowledge", "", "framework", "en", False, "", "far", "Far away."), ("e", [1.0, 0.0], "knowledge", "", "framework", "en", True, "", "numbers", "It was 5 tons.")]
    index = spark.createDataFrame(rows, "item_id string, vector array<double>, lane string, institution string, source_type string, language string, has_quantity boolean, pillar string, source string, text string")
    embedded = spark.createDataFrame([("s", [1.0, 0.0])], "query_id string, query array<double>")
    sections = spark.createDataFrame([("s", "1-1")], "section string, disclosure string")
    found = N.passages(sections, index, embedded, "U", T.reference_pattern(["1-1"]))
    got = {(r.kind, r.text) for r in found.collect()}
    assert {k for k, _ in got} == {"evidence", "style"} and len(got) == 2
    assert ("style", "[guide] Write plainly.") in got and not any("15" in t for _, t in got)
    prompt = N.prompts(found, spark.createDataFrame([("s", "T")], "section string, title string")).first().prompt
    assert prompt.index("EVIDENCE") < prompt.index("STYLE")


def test_first_available_embedder_and_lexical_vectors(spark):
    from lodestone.operators import embedding as E

    texts = spark.createDataFrame([(1, "green energy"), (2, "green water"), (3, ""), (4, "green energy")], "k int, text string")

    def model():
        raise ImportError("no such library")

    with pytest.warns(UserWarning, match="no such library"):
        embedder = E.first_available([model, lambda: E.LexicalEmbedder.fit(texts, "k", "text")])
    got = {r.k: (r.vector, r.backend) for r in embedder.encode(texts, "k", "text").collect()}
    assert got[3] == ({}, "tfidf") and got[1] == got[4] and set(got[1][0]) == {"green", "energy"} and set(got[2][0]) == {"green"}
    assert sum(w * w for w in got[1][0].values()) == pytest.approx(1)
    with pytest.warns(UserWarning), pytest.raises(LookupError):
        E.first_available([model])


def test_nfkc(spark):
    from lodestone.functions import text as T

    df = spark.createDataFrame([("ﬁne  m²\u00a0x",), ("plain",), (None,)], "t string")
    assert [r.t for r in T.nfkc(df, "t").collect()] == ["fine m2 x", "plain", None]
