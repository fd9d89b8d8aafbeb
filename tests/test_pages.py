"""Cached pages to records."""

from lodestone.operators import pages as P


def one(spark, html, **more):
    return [r.asDict() for r in P.fields(spark.createDataFrame([("U", "OP-6", html)], "institution string, credit_code string, html string"), **more).orderBy("ord").collect()]


def test_a_new_indicator_ends_the_section(spark):
    field = lambda t, v: f"<div class='scorecardFieldTitle'>{t}:</div><div class='well'>{v}</div>"
    head = lambda x: f"<div class='field-header'>{x}</div>"
    got = one(spark, head("<h4>6.1</h4><h5>Scope 1</h5>") + field("a", "1") + head("<h5>Scope 3</h5>") + field("b", "2") + head("<p>guidance</p>") + field("c", "3") + head("<h4>6.2</h4>") + field("d", "4"))
    assert [(r["field"], r["indicator"], r["section"], r["value_numeric"]) for r in got] == [("a", "6.1", "Scope 1", 1.0), ("b", "6.1", "Scope 3", 2.0), ("c", "6.1", "Scope 3", 3.0), ("d", "6.2", "", 4.0)]


def test_units_are_italics_after_a_bare_number_alone(spark):
    title = "<span class='scorecardFieldTitle'>f</span>"
    wells = ["<div><div>12.5</div></div><i>m2</i>", "as <i>said</i> before", "-", "1,000", "<p>a</p><div>b<div>c</div></div>d", ""]
    got = one(spark, "".join(f"{title}<div class='well'>{w}</div>left out" for w in wells))
    assert [(r["value"], r["units"], r["value_type"]) for r in got] == [("12.5", "m2", "number"), ("as said before", "", "text"), ("", "", "not_reported"), ("1,000", "", "number"), ("a b c d", "", "text"), ("", "", "not_reported")]


def test_a_title_without_a_well_of_its_own(spark):
    got = one(spark, "<h1>X OP-6: Emissions</h1><div class='scorecardFieldTitle'>a</div><div class='scorecardFieldTitle'>b</div><div class='well'><a href='/x'>l</a></div>", base="https://h")
    assert [(r["field"], r["value"], r["links"], r["credit_name"], r["category"]) for r in got] == [("a", "l", "https://h/x", "Emissions", "OP"), ("b", "", "", "Emissions", "OP")]
    assert {r["pillar"] for r in got} == {"Environmental"}


def test_pages_without_fields_and_few_questions(spark):
    assert one(spark, "<p>nothing</p>") == [] and one(spark, "") == [] and one(spark, None) == []
    rows = P.fields(spark.createDataFrame([("U", "OP-1", "<div class='scorecardFieldTitle'>a</div>")], "institution string, credit_code string, html string"))
    assert [tuple(r) for r in P.few_questions(rows).collect()] == [("U", 1)] and P.few_questions(rows, 1).count() == 0


def test_scorecard_of_an_empty_page(spark):
    assert P.scorecard(spark.createDataFrame([("U", "<table></table>"), ("V", None)], "institution string, html string")).count() == 0
