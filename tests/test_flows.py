"""The pipeline from files to tables, by its command line, on a small world with known answers."""

import csv
import json
import sys

import pytest
from pyspark.sql import functions as F

from lodestone import flows
from lodestone.__main__ import main
from lodestone.functions import text as T
from lodestone.functions.fixed import HEADER_RULE
from lodestone.operators import vectors, writing
from lodestone.sources import files, schemas, sinks


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


@pytest.fixture(scope="module")
def world(tmp_path_factory):
    d = tmp_path_factory.mktemp("world")
    for key, extra in (("a", []), ("b", [["OP-7", "Air", "Complete", "", "4"]])):
        rows = [[f"University, {key.upper()}", "Operations", "OP", code, name, status, score, most] for code, name, status, score, most in [["OP-6", "Gas", "Complete", "6.825", "10"], ["PA-2", "Plan", "Not Applicable", "N/A", "0"], *extra]]
        write(d / f"{key}.csv", schemas.SCORES.fieldNames(), rows)
    field = lambda inst, code, name, value, units="", number="", kind="text": [f"University, {inst}", code, "c", "p", "n", "i", "s", name, value, units, number, kind, ""]
    rows = [field("A", "OP-6", "Scope 1", "1,200", "t", "1200", "number"), field("A", "OP-6", "Scope 1 per person", "3", "t", "3", "number"), field("A", "OP-6", "Notes", "prose | with bar"), field("B", "OP-6", "Scope 1", "None"), field("B", "OP-6", "Scope 1 per person", "4", "t", "4", "number")]
    write(d / "fields.csv", schemas.FIELDS.fieldNames(), rows)
    rule = lambda credit, name, disc, rel, state="confirmed", caveat="": [credit, name, "S 305", disc, rel, "high", state, "why", caveat, "", "", "", ""]
    rows = [rule("OP-6", "Scope 1", "305-1", "equivalent", caveat="Differs. Twice."), rule("OP-6", "Notes", "305-1", "component", caveat="Twice. More."), rule("OP-6", "Scope 1 per person", "305-4", "partial", caveat="Not the same."), rule("", "", "305-5", "gap_gri_side"), rule("OP-6", "Notes", "305-6", "equivalent", "rejected")]
    write(d / "mapping.csv", schemas.MAPPING.fieldNames(), rows)
    write(d / "bad.csv", schemas.MAPPING.fieldNames(), [*rows, rule("OP-6", "Invented", "305-1", "equivalent"), rule("OP-6", "Scope 1", "305-99", "equivalent")])
    (d / "vocabulary.json").write_text(json.dumps({"standards": {"S 305": {"title": "T", "family": "F", "source_url": "u", "disclosures": {f"305-{k}": f"t{k}" for k in (1, 4, 5, 6, 7)}}}}), encoding="utf-8")
    (d / "corpus").mkdir()
    line = "Emissions of carbon are reported under the framework and its disclosures each year."
    (d / "corpus" / "one.txt").write_text(f"SOURCE: one\nURL: https://x\n{HEADER_RULE}\n" + "\n".join([line] * 30), encoding="utf-8")
    (d / "corpus" / "two.txt").write_text(f"SOURCE: two\nURL: https://y\n{HEADER_RULE}\n" + "\n".join(["Water use on campus fell when old pipes were replaced with new pipes."] * 30), encoding="utf-8")
    (d / "corpus" / "thin.txt").write_text(f"SOURCE: thin\n{HEADER_RULE}\ntoo short", encoding="utf-8")
    return d


def run(spark, *args):
    return main([str(a) for a in args], spark)


def test_from_files_to_tables(spark, world):
    d = world
    assert run(spark, "combine", "--out", d / "scores", f"3.0={d}/a.csv", f"3.0={d}/b.csv") == 0
    scores = spark.read.parquet(f"{d}/scores")
    assert scores.columns == schemas.COMBINED.fieldNames() and scores.count() == 5
    assert sorted({r.pillar for r in scores.collect()}) == ["Environmental", "Governance"]
    assert run(spark, "master", "--scores", d / "scores", "--fields", d / "fields.csv", "--out", d / "master") == 0
    joined = sinks.read_published(spark, f"{d}/master")
    assert joined.where("anchor").agg(F.round(F.sum("score"), 3)).first()[0] == 13.65 < joined.agg(F.sum("score")).first()[0]
    assert joined.count() == 5 + 3
    common = ["--mapping", d / "mapping.csv", "--vocabulary", d / "vocabulary.json", "--master", d / "master"]
    assert run(spark, "validate", *common) == 0
    assert run(spark, "validate", "--mapping", d / "bad.csv", *common[2:]) == 1
    both = ["--institution", "a=University, A", "--institution", "b=University, B"]
    assert run(spark, "bi", *common, *both, "--out", d / "bi") == 0
    pct = {(r.institution_key, r.credit_code): r.pct_of_max for r in spark.read.parquet(f"{d}/bi/scores").collect()}
    assert pct == {("a", "OP-6"): 68.2, ("a", "PA-2"): None, ("b", "OP-6"): 68.2, ("b", "PA-2"): None, ("b", "OP-7"): None}
    metrics = {(r.institution, r.field): (r.disclosure, r.comparable, r.is_intensity) for r in spark.read.parquet(f"{d}/bi/metrics").collect()}
    assert metrics == {("University, A", "Scope 1"): ("305-1", False, False), ("University, A", "Scope 1 per person"): ("305-4", True, True), ("University, B", "Scope 1 per person"): ("305-4", True, True)}
    status = {(r.entity[-1], r.disclosure): r.status for r in spark.read.parquet(f"{d}/bi/coverage").collect()}
    assert len(status) == 10 and {k[1]: v for k, v in status.items() if k[0] == "A"} == {"305-1": "Reported", "305-4": "Partially reported", "305-5": "Not reported", "305-6": "Not reported", "305-7": "Not assessed"}
    assert status["B", "305-1"] == "Not reported"
    assert run(spark, "index", *common, *both, "--out", d / "index") == 0
    rows = {(r.entity[-1], r.disclosure): r for r in spark.read.parquet(f"{d}/index/index").collect()}
    assert {k: r.status for k, r in rows.items()} == status
    assert rows["A", "305-1"].detail == "**Notes**: prose \\| with bar<br>**Scope 1**: 1,200 t" and rows["A", "305-1"].note == "Differs. Twice. More."
    printed = {(r.entity, r.field, r.value) for r in spark.read.parquet(f"{d}/index/provenance").where("populated").collect()}
    assert printed == {("University, A", "Scope 1", "1,200"), ("University, A", "Notes", "prose | with bar"), ("University, A", "Scope 1 per person", "3"), ("University, B", "Scope 1 per person", "4")}


def test_orphans_stop_the_master(spark, world):
    d = world
    fields = files.read_csv(spark, f"{d}/fields.csv", schemas.FIELDS)
    scores = flows.combined([("3.0", files.read_csv(spark, f"{d}/a.csv", schemas.SCORES))])
    bad = flows.reconciliation(scores, fields, flows.master(scores, fields)).where("expected <> actual").collect()
    assert [r.check for r in bad] == ["orphan fields"]


def test_corpus_to_search(spark, world, capsys):
    d = world
    write(d / "summary.csv", ["source", "flags"], [["two", "FRENCH"]])
    assert run(spark, "chunk", "--corpus", d / "corpus", "--summary", d / "summary.csv", "--out", d / "chunks") == 0
    chunks = files.read_json_lines(spark, f"{d}/chunks", schemas.CHUNK)
    assert {r.source for r in chunks.collect()} == {"one", "two"} and {r.language for r in chunks.where("source = 'two'").collect()} == {"fr"}
    capsys.readouterr()
    for more, source in (([], "one"), (["--any-language"], "two")):
        assert run(spark, "search", "--chunks", d / "chunks", "-k", 1, *more, "water pipes and carbon" if more else "carbon") == 0
        assert f"|{source}" in capsys.readouterr().out
    hits = flows.search(chunks, spark.createDataFrame([(0, "water pipes")], "query_id int, text string"), 1).collect()
    assert [h.id.split("-")[0] for h in hits] == ["two"]


def test_index_says_why_there_is_no_value(spark):
    from lodestone import flows
    from lodestone.sources import config

    joined = spark.createDataFrame([("Uni", "C-1", "f", "7", "kg", "number", True, True, 7.0)], "institution string, credit_code string, field string, value string, units string, value_type string, has_detail boolean, anchor boolean, value_numeric double").selectExpr("*", "cast(null as string) as score", "cast(null as string) as max")
    m = [(2, "C-1", "f", "S", "10-1", "equivalent", "confirmed", "", None), (3, None, None, "S", "9-2", "gap_gri_side", "confirmed", "", "no such data"), (4, "C-1", "g", "S", "9-10", "component", "rejected", "", "wrong scope"), (5, "C-1", "f", "S", "9-11", "component", "proposed", "", None)]
    mapping = spark.createDataFrame(m, "line int, stars_credit string, stars_field string, gri_standard string, gri_disclosure string, relationship string, review_status string, rationale string, caveat string")
    vocabulary = spark.createDataFrame([("S", d, f"T {d}") for d in ("10-1", "9-2", "9-10", "9-11", "9-12")], "standard string, disclosure string, title string")
    known = config.institutions(spark, [config.Institution("u", "Uni")])
    rows, _ = flows.content_index(joined, mapping, vocabulary, known)
    got = [(r.disclosure, r.title, r.status, r.detail, r.note) for r in rows.orderBy("place").collect()]
    assert got == [
        ("9-2", "T 9-2", "Not reported", "No data exists for this disclosure.", "no such data"),
        ("9-10", "T 9-10", "Not reported", "Assessed: the nearest field (C-1 / g) was reviewed and rejected as an answer to this disclosure.", "wrong scope"),
        ("9-11", "T 9-11", "Not assessed", "", ""), ("9-12", "T 9-12", "Not assessed", "", ""), ("10-1", "T 10-1", "Reported", "**f**: 7 kg", ""),
    ]
    notes = [config.Note("u", "undercounted", credit="C-1"), config.Note("v", "other")]
    tables = flows.bi_tables(joined, mapping, vocabulary, known, 1, notes)
    assert [r.data_quality for r in tables["metrics"].collect()] == ["undercounted"]
    assert {r.disclosure: r.status for r in tables["coverage"].collect()}["9-11"] == "Not reported"
    (text,) = [r.markdown for r in flows.rendered_index(rows, "With reference to the standards.").collect()]
    assert text.startswith("# Content index — Uni\n\nWith reference to the standards.\n\n| Reported | Partially reported | Not reported | Not assessed |\n|---|---|---|---|\n| 1 | 0 | 2 | 2 |\n\n## S\n\n| Disclosure |")
    assert text.index("**9-2** T 9-2") < text.index("**9-10** T 9-10") < text.index("| **10-1** T 10-1 | Reported | **f**: 7 kg |") and "| — |" in text


def test_review_amend_candidates_and_narrative(spark, world, capsys):
    d = world
    for name in ("a", "b"):
        assert run(spark, "combine", "--out", d / f"scores_{name}", f"3.0={d}/a.csv", f"3.0={d}/b.csv") == 0
    assert run(spark, "master", "--scores", d / "scores_a", "--fields", d / "fields.csv", "--out", d / "joined") == 0
    joined = sinks.read_published(spark, f"{d}/joined")
    (d / "pages").mkdir()
    (d / "pages" / "305.html").write_text("<h2>Disclosure 305-1 t1</h2><p>Report scope one.</p><p>And more.</p><h2>305-2 t2</h2><p>x</p>", encoding="utf-8")
    assert run(spark, "requirements", "--pages", d / "pages", "--vocabulary", d / "vocabulary.json", "--retrieved", "2025-01-01", "--out", d / "req") == 0
    assert [(r.number, r.standard, r.text) for r in files.read_requirements(spark, f"{d}/req").orderBy("number").collect()] == [("305-1", "S 305", "Report scope one.\nAnd more."), ("305-2", None, "x")]
    assert "unlisted" in capsys.readouterr().out

    rule = lambda credit, name, disc, rel, state, caveat="", why="why": [credit, name, "S 305", disc, rel, "high", state, why, caveat, "", "", "", ""]
    head = schemas.MAPPING.fieldNames()
    write(d / "todo.csv", head, [rule("OP-6", "Scope 1", "305-1", "equivalent", "proposed"), rule("", "", "305-5", "gap_gri_side", "proposed"), rule("OP-6", "Notes", "305-1", "component", "confirmed")])
    m = spark.createDataFrame([(2, *rule("OP-6", "Scope 1", "305-1", "equivalent", "proposed")), (3, *rule(None, None, "305-5", "gap_gri_side", "proposed"))], "line int, " + ", ".join(f"{c} string" for c in head))
    rows = flows.review(m, files.read_requirements(spark, f"{d}/req"), joined, lines=1).orderBy("line").collect()
    assert (rows[0].requirement, rows[0].values, rows[0].reported, rows[0].asked) == ("Report scope one.\n... 1 more line(s)", "University, A: 1,200 t\nUniversity, B: not reported", 1, 2)
    assert rows[1].requirement is None and rows[1].asked is None
    assert run(spark, "review", "--mapping", d / "todo.csv", "--master", d / "joined", "--requirements", d / "req") == 0

    write(d / "changes.csv", head, [rule("OP-6", " Scope 1", "305-1", "equivalent", "confirmed"), rule("OP-6", "Gone", "305-1", "partial", "confirmed"), rule("OP-6", "Notes", "305-1", "component", "confirmed")])
    write(d / "inserts.csv", head, [rule("OP-6", "Notes", "305-1", "component", "confirmed"), rule("PA-2", "New", "305-7", "partial", "confirmed", "mind")])
    amend = ["amend", "--mapping", d / "todo.csv", "--changes", d / "changes.csv", "--inserts", d / "inserts.csv", "--out", d / "amended"]
    assert run(spark, *amend) == 0 and not (d / "amended").exists()
    assert run(spark, *amend, "--write") == 0
    got = {(r.stars_field, r.gri_disclosure): r.review_status for r in files.read_csv(spark, f"{d}/amended", schemas.MAPPING).collect()}
    assert got == {("Scope 1", "305-1"): "confirmed", (None, "305-5"): "proposed", ("Notes", "305-1"): "confirmed", ("New", "305-7"): "confirmed"}
    plain = [files.read_csv(spark, f"{d}/{n}.csv", schemas.MAPPING) for n in ("todo", "changes", "inserts")]
    assert {r.outcome: r.rows for r in flows.amended(*plain)[1].collect()} == {"applied": 1, "already": 1, "missing": 1, "inserted": 1}

    asked = spark.createDataFrame([("305-4", "per person", None), ("305-9", "nothing alike", None)], "disclosure string, title string, text string")
    best = flows.candidate_fields(asked, joined).collect()
    assert {(r.disclosure, r.field) for r in best if r.score > 0} <= {("305-4", "Scope 1 per person")}
    assert run(spark, "candidates", "--master", d / "joined", "--mapping", d / "todo.csv", "--vocabulary", d / "vocabulary.json", "--requirements", d / "req") == 0

    write(d / "sections.csv", ["section", "title", "disclosure"], [["ghg", "Gases", "305-1"], ["ghg", "Gases", "305-4"], ["ghg", "Gases", "305-5"]])
    common = ["narrative", "--mapping", d / "mapping.csv", "--vocabulary", d / "vocabulary.json", "--master", d / "joined", "--sections", d / "sections.csv", "--out", d / "prose"]
    assert run(spark, *common) == 0
    stub = {r.entity[-1]: r for r in sinks.read_published(spark, f"{d}/prose.preview").collect()}
    assert not (d / "prose").exists() and "1,200 t" in stub["A"].rendered and all(r.publishable for r in stub.values())
    assert run(spark, *common, "--writer", "rogue") == 0
    assert {n for r in sinks.read_published(spark, f"{d}/prose.preview").collect() for n in r.invented} == {"31,337", "19"} and not (d / "prose").exists()


def test_a_cached_section_is_not_written_again(spark):
    found = spark.createDataFrame([("U", "s", "figure", "1-1", "C", "f", "f", "7 kg"), ("U", "s", "caveat", "1-1", "C", "f", None, "since 2019")], "entity string, section string, kind string, disclosure string, credit string, field string, token string, text string")
    titles = spark.createDataFrame([("s", "T")], "section string, title string")

    class Once:
        name, calls = "once", 0

        def write(self, system, prompt, tokens):
            assert "7 kg" not in prompt and self.calls == 0
            self.calls += 1
            return "It is {{ " + tokens[0] + " }} since 2019, not 8."

    rows, cache = flows.narrative(found, titles, Once(), "sys", T.reference_pattern(["1-1"]))
    for _ in range(2):
        (r,) = rows.collect()
        assert (r.rendered, r.invented, r.review, r.publishable) == ("It is 7 kg since 2019, not 8.", ["8"], ["2019"], False)
        busy = Once()
        busy.calls = 1
        rows, again = flows.narrative(found, titles, busy, "sys", T.reference_pattern(["1-1"]), cache)
        assert again.count() == 1


def test_institution_lane_beside_the_corpus(spark, world):
    d = world
    (d / "texts").mkdir()
    line = "The campus plan states that 7 MWh were saved in the halls of residence this year."
    for name in ("d1", "d2", "d3", "d4"):
        (d / "texts" / f"{name}.txt").write_text("\n".join([line] * (3 if name != "d4" else 4)), encoding="utf-8")
    row = lambda inst, name, local, state="ok": ["https://u", inst, "OP-6", "f", name, local, "1", "ok", "", state, "9"]
    write(d / "manifest.csv", schemas.MANIFEST.fieldNames(), [row("University, A", "Plan.PDF", "d1.pdf"), row("University, A", "Same.pdf", "d2.pdf"), row("University, B", "Ledger.XLSM", "d3.xlsm"), row("Elsewhere", "Other.pdf", "d4.pdf"), row("University, B", "Broken.pdf", "d4.pdf", "failed")])
    assert run(spark, "chunk", "--corpus", d / "corpus", "--manifest", d / "manifest.csv", "--documents", d / "texts", "--institution", "a=University, A", "--institution", "b=University, B", "--out", d / "lanes") == 0
    rows = files.read_json_lines(spark, f"{d}/lanes", schemas.CHUNK).where("lane = 'institution'").collect()
    assert [(r.id, r.text.split("\n")[0], r.institution_key, r.has_quantity, r.chars) for r in rows] == [("doc::a::d1.pdf::0000", "Plan.PDF", "a", True, len("\n".join([line] * 3)))]
    listed = files.read_manifest(spark, f"{d}/manifest.csv", f"{d}/texts")
    assert {r.outcome: r.documents for r in flows.document_outcomes(listed).collect()} == {"indexed": 2, "duplicate": 1, "spreadsheet": 1}


@pytest.fixture(scope="module")
def told(spark, world):
    """The world with a master table, chunks of both lanes, an outline, and a module of writers that tasks can import."""
    d = world
    if not (d / "told").exists():
        assert run(spark, "combine", "--out", d / "told_scores", f"3.0={d}/a.csv", f"3.0={d}/b.csv") == 0
        assert run(spark, "master", "--scores", d / "told_scores", "--fields", d / "fields.csv", "--out", d / "told") == 0
    write(d / "told_manifest.csv", schemas.MANIFEST.fieldNames(), [[f"https://x/{k}", f"University, {who}", "OP-6", "f", f"plan {k}.docx", f"plan{k}.docx", "1", "ok", "", "ok", "5"] for k, who in (("1", "A"), ("2", "B"))])
    (d / "told_texts").mkdir(exist_ok=True)
    for k, word in (("1", "boilers"), ("2", "forests")):
        (d / "told_texts" / f"plan{k}.txt").write_text(f"Emissions of gases are cut by 31 percent with new {word} on campus. " * 12, encoding="utf-8")
    assert run(spark, "chunk", "--corpus", d / "corpus", "--manifest", d / "told_manifest.csv", "--documents", d / "told_texts", "--institution", "a=University, A", "--institution", "b=University, B", "--out", d / "told_chunks") == 0
    write(d / "told_sections.csv", ["section", "title", "brief", "disclosure"], [["water", "Water", "", "305-7"], ["ghg", "Gases", "emissions of gases on campus", "305-1"], ["ghg", "Gases", "emissions of gases on campus", "305-4"]])
    (d / "own_writers.py").write_text(
        "class Model:\n    name = model = 'm-1'\n    said = 'Prose'\n    def write(self, system, prompt, tokens):\n"
        "        about = [w for w in ('boilers', 'forests', 'COVER: emissions', 'STYLE', '[figure]') if w in prompt]\n        assert '31 percent' not in prompt\n"
        "        return self.said + ' on ' + ', '.join(about) + '. ' + ' '.join('It is {{ ' + t + ' }}.' for t in tokens)\n"
        "class Newer(Model):\n    model = 'm-2'\n    said = 'Newer prose'\n"
        "class Never(Model):\n    def write(self, system, prompt, tokens):\n        raise ValueError('asked again')\n",
        encoding="utf-8",
    )
    spark.sparkContext.addPyFile(str(d / "own_writers.py"))
    sys.path.insert(0, str(d))
    yield d
    sys.path.remove(str(d))


def test_narrative_resumes_from_its_cache(spark, told, capsys):
    d = told
    common = ["narrative", "--mapping", d / "mapping.csv", "--vocabulary", d / "vocabulary.json", "--master", d / "told", "--sections", d / "told_sections.csv", "--chunks", d / "told_chunks", "--cache", d / "said", "--out", d / "story", "--pace", "0"]
    assert run(spark, *common, "--writer", "stub") == 0 and not (d / "story").exists() and not spark.read.parquet(f"{d}/said").count()
    # a day's calls are for one section only: what is done is kept, nothing is published
    assert run(spark, *common, "--writer", "own_writers:Model", "--per-day", "1", "--ledger", d / "other_ledger") == 1
    assert not (d / "story").exists() and sinks.read_published(spark, f"{d}/story.preview").count() == 1 and spark.read.parquet(f"{d}/said").count() == 1
    assert run(spark, *common, "--writer", "own_writers:Model") == 0
    story = {r.entity[-1]: r for r in sinks.read_published(spark, f"{d}/story").collect()}
    assert set(story) == {"A", "B"} and all(r.section == "ghg" and r.publishable and r.model == "m-1" for r in story.values())
    assert "boilers" in story["A"].rendered and "forests" not in story["A"].rendered and "forests" in story["B"].rendered and "1,200 t" in story["A"].rendered
    assert all("COVER: emissions" in r.rendered and "[figure]" in r.rendered for r in story.values())
    capsys.readouterr()
    assert run(spark, *common, "--writer", "own_writers:Never") == 0
    assert "failed" not in capsys.readouterr().out and sinks.read_published(spark, f"{d}/story").count() == 2
    assert run(spark, *common, "--writer", "own_writers:Newer", "--no-cache", "--section", "ghg") == 0
    assert {r.model for r in sinks.read_published(spark, f"{d}/story").collect()} == {"m-1"}
    assert {r.rendered.split(" on ")[0] for r in sinks.read_published(spark, f"{d}/story.preview").collect()} == {"Newer prose"}
    assert {r.model for r in writing.remembered(spark, f"{d}/said").collect()} == {"m-2"} and spark.read.parquet(f"{d}/said").count() == 4
    known = ["--institution", "a=University, A", "--institution", "b=University, B"]
    assert run(spark, "index", "--mapping", d / "mapping.csv", "--vocabulary", d / "vocabulary.json", "--master", d / "told", "--out", d / "story_index", *known) == 0
    assert run(spark, "report", "--narrative", d / "story", "--index", d / "story_index", "--sections", d / "told_sections.csv", "--out", d / "full", "--html") == 0
    full = {r.entity[-1]: r for r in spark.read.parquet(f"{d}/full").collect()}
    assert full["A"].markdown.startswith("# Sustainability report — University, A\n\n| Sections | Written by |") and "| 1 | m-1 | 0 | 0 |" in full["A"].markdown and full["A"].markdown.count("\n# ") == 1
    assert "<h2>Gases</h2>" in full["A"].html and "<td>Reported</td>" in full["A"].html and full["A"].html.endswith("</html>\n")
    with pytest.raises(ImportError):
        run(spark, *common, "--writer", "own_writers:Nobody")


def test_search_is_safe_as_a_command(spark, told, capsys):
    d = told
    search = lambda *more: (run(spark, "search", "--chunks", d / "told_chunks", *more), capsys.readouterr().out)[1]
    assert "plan 1" in search("boilers on campus", "--lane", "institution", "--institution", "a") and "plan 2" not in search("emissions on campus", "--lane", "institution", "--institution", "sity, A")
    both = search("emissions on campus", "--lane", "all", "--institution", "b")
    assert "plan 2" in both and "plan 1" not in both and "knowledge" in both
    assert "plan" not in search("emissions on campus") and "plan" not in search("emissions", "--lane", "institution", "--institution", "a", "--min-score", "1.1")
    assert "word for word" in search("what does GRI 305-1 ask")
    for wrong in (["--lane", "institution"], ["--lane", "all"]):
        with pytest.raises(vectors.LaneMisuse):
            search("emissions", *wrong)
    with pytest.raises(LookupError):
        search("emissions", "--lane", "institution", "--institution", "University")
    write(d / "questions.csv", ["question", "expected"], [["emissions of carbon reported", "one"], ["water on campus pipes", "one"], ["quantum", ""]])
    assert run(spark, "evaluate", "--chunks", d / "told_chunks", "-k", "1", d / "questions.csv") == 0
    shown = capsys.readouterr().out
    assert "|        3|   1|   1|" in shown
    found = {r.question[:3]: r for r in flows.evaluated(files.read_json_lines(spark, f"{d}/told_chunks", schemas.CHUNK).where("lane = 'knowledge'"), spark.read.csv(str(d / "questions.csv"), header=True), 1).collect()}
    assert (found["emi"].source, found["emi"].hit, found["wat"].source, found["wat"].hit, found["qua"].weak, found["qua"].hit) == ("one", True, "two", False, True, None)
    assert run(spark, "index-chunks", "--chunks", d / "told_chunks", "--out", d / "told_index", "--backend", "no_such_module:Embedder") == 0
    index = spark.read.parquet(f"{d}/told_index")
    assert {r[0] for r in index.select("backend").distinct().collect()} == {"tfidf"} and {r[0] for r in index.select("lane").distinct().collect()} == {"knowledge", "institution"}
