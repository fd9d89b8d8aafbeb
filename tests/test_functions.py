import hashlib

import pytest
from pyspark.sql import functions as F

from lodestone.functions import nulls as N
from lodestone.functions import text as T
from lodestone.functions import values as V

VOCABULARY = ["305-1", "305-10", "403-10", "403-1", "2-9", "305"]
REFERENCES = T.reference_pattern(VOCABULARY)


def each(spark, values, f):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.o for r in rows.select("k", f(F.col("v")).alias("o")).orderBy("k").collect()]


def test_missing(spark):
    assert each(spark, [None, "", " ", "*", "x", "-"], N.is_blank) == [True, True, True, True, False, False]
    assert each(spark, ["None", "N/A", "", "-", "---", "a"], N.missing_to_null) == [None, None, None, "-", "---", "a"]
    assert each(spark, [None, "a", "b"], lambda c: N.not_in(c, "a")) == [True, False, True]
    assert each(spark, [None, " a "], lambda c: N.row_key("v", "v")) == ["\x1f", "a\x1fa"]


def test_value_types(spark):
    rows = [("Rooms", "", ""), ("Rooms", "1,234.5", "kg"), ("Performance year", "2021", ""), ("Performance year", "2021", "kg"), ("Rooms", ",", ""), ("x", "Yes", ""), ("x", "https://a", ""), ("x", "Feb. 3, 2024", ""), ("x", "2024-02-03", ""), ("x", "y" * 201, ""), ("x", "y" * 200, ""), ("x", None, None), ("start date", "1850", "")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, f string, v string, u string")
    got = df.select("k", V.value_type(F.col("f"), F.col("v"), F.col("u")).alias("t"), V.value_numeric(F.col("v")).alias("n")).orderBy("k").collect()
    assert [r.t for r in got] == ["not_reported", "number", "year", "number", "number", "boolean", "url", "date", "date", "text_long", "text", "not_reported", "number"]
    assert [r.n for r in got][:5] == [None, 1234.5, 2021.0, 2021.0, None]


def test_half_even_and_pairs(spark):
    df = spark.createDataFrame([(68.25, 100.0), (56.25, 100.0), (83.25, 100.0), (1.0, 0.0), (None, 3.0)], "a double, b double")
    assert [r.o for r in df.select(V.percentage(F.col("a"), F.col("b")).alias("o")).collect()] == [68.2, 56.2, 83.2, None, None]
    assert each(spark, ["3.5 / 8", " / 4", "x"], lambda c: V.score_pair(c)[0]) == [3.5, None, None]
    assert each(spark, ["3.5 / 8", " / 4", "x"], lambda c: V.score_pair(c)[1]) == [8.0, 4.0, None]


def test_codes_and_orders(spark):
    codes = ["OP-6", "PA-5", "PA-6", "AC-1", "EN-2", "IL-9", "PRE-1", "ZZ-1"]
    assert each(spark, codes, V.pillar) == ["Environmental", "Governance", "Social", "Context", "Context", "Bonus", "Preface", "Unknown"]
    df = spark.createDataFrame([(x,) for x in ["305-10", "bad", "2-10", "305-1", "202-1", "2-9"]], "n string")
    assert [r.n for r in df.orderBy(*V.compound_key(F.col("n"))).collect()] == ["2-9", "2-10", "202-1", "305-1", "305-10", "bad"]
    assert each(spark, ["b", "z", "a", None], lambda c: V.position(c, ["a", "b"])) == [2, 3, 1, 3]


def test_units(spark):
    df = spark.createDataFrame([("1,200", "tonnes"), ("see note", "emphasis"), ("---", None)], "v string, i string")
    assert [tuple(r) for r in df.select(*V.split_units(F.col("v"), F.col("i"))).collect()] == [("1,200", "tonnes"), ("see note emphasis", ""), ("", "")]
    rows = [("Total", "5", "kg"), ("Percentage of x", "96.20", ""), ("Number of weeks of paid leave", "26", None), ("Year", "2020", " ")]
    df = spark.createDataFrame(rows, "l string, v string, u string")
    assert [r[0] for r in df.select(V.with_unit(F.col("l"), F.col("v"), F.col("u"))).collect()] == ["5 kg", "96.20%", "26 weeks", "2020"]
    assert each(spark, [None, "a|b", "x" * 91, "x" * 90], lambda c: V.cell(c, F.lit("u"))) == ["not reported by the institution", "a\\|b u", "x" * 87 + "…", "x" * 90 + " u"]


@pytest.mark.parametrize("text", ["40-50", "61-70 percent", "2-3 percent", "2-9 years", "305-1", "GRI 999-9"])
def test_ranges_shaped_like_references_are_figures(spark, text):
    assert each(spark, [text], lambda c: T.numbers_in(c, REFERENCES))[0]


@pytest.mark.parametrize("text", [f"{p} {n}" for p in ("GRI", "Disclosure", "disclosures") for n in VOCABULARY] + ["GRI 305-1, 305-10, and 403-10 hold", "Scopes 1, 2 and 3", "Scope 2"])
def test_prefixed_references_are_not(spark, text):
    assert each(spark, [text], lambda c: T.numbers_in(c, REFERENCES)) == [[]]


def test_numbers(spark):
    assert each(spark, ["GRI 305-1 and 4,858 t in 2024.", "Scope 2, 3,565 t", "none", "..."], lambda c: T.numbers_in(c, REFERENCES)) == [["4,858", "2024"], ["3,565"], [], []]
    assert each(spark, ["0.21 MWh, GRI 2-9, 45 at A", "Scopes 1 and 2 of 7"], lambda c: T.redact_figures(c, REFERENCES)) == ["[figure] MWh, GRI 2-9, [figure] at A", "Scopes 1 and 2 of [figure]"]


def test_audit(spark):
    df = spark.createDataFrame([("5 kg, 5 again, 7 near, 9 made up. Twenty or two.", ["5 kg"], ["7 of 8"])], "r string, s array<string>, c array<string>")
    got = df.select(T.audit_digits(F.col("r"), F.col("s"), F.col("c"), REFERENCES).alias("a")).select("a.*").first()
    assert got.asDict() == {"ok": ["5", "5"], "review": ["7"], "invented": ["9"], "spelled": ["twenty", "two"]}


def test_slugs_do_not_collide(spark):
    long = "Scope 2 emissions from off-site sources of electricity and heat for all of the sites"
    rows = [(1, "OP-6", f"{long} (market)"), (1, "OP-6", f"{long} (location)"), (2, "OP-6", f"{long} (market)"), (1, "OP-6", "Short!"), (1, "OP-6", "Short!")]
    df = spark.createDataFrame(rows, "g int, c string, f string")
    names = {(r.g, r.f): r.token for r in T.unique_slugs(df, ["g"], ["c", "f"]).collect()}
    assert names[1, "Short!"] == "op_6_short"
    a, b, c = names[1, rows[0][2]], names[1, rows[1][2]], names[2, rows[2][2]]
    assert a != b and a.endswith(hashlib.sha1(f"OP-6 {rows[0][2]}".encode()).hexdigest()[:6]) and max(map(len, (a, b, c))) <= 60
    assert not c.endswith(hashlib.sha1(f"OP-6 {rows[0][2]}".encode()).hexdigest()[:6])


def test_templates(spark):
    df = spark.createDataFrame([("a {{ x }} b {{y}}{{x}}", {"x": "1", "y": "2"})], "t string, m map<string,string>")
    assert df.select(T.render(F.col("t"), F.col("m"))).first()[0] == "a 1 b 21"
    with pytest.raises(Exception, match="unknown token: y"):
        spark.createDataFrame([("{{ y }}", {"x": "1"})], "t string, m map<string,string>").select(T.render(F.col("t"), F.col("m"))).collect()


def test_quantities(spark):
    texts = ["15% of", "15 percent", "26,000 tons", "2024", "5€", "12 kWh", "tons of 3", "5%x"]
    assert each(spark, texts, T.has_quantity) == [True, True, True, False, True, True, False, True]
    assert each(spark, texts, lambda c: T.has_quantity(c, parity=True)) == [False, True, True, False, False, True, False, True]


def test_pages(spark):
    assert each(spark, ["a {{x}} b  \n\n \n c\n{{ y }}\n"], T.scrub) == ["a  b\n c"]
    assert each(spark, ["Please ENABLE javascript"], T.is_wall) == [True]
    flags = each(spark, ["word " * 300, "esg " * 300, "", "esg {{ pricing pricing pricing pricing pricing"], T.quality_flags)
    assert flags == [["LOW-ESG(0/1k)"], [], ["LOW-ESG(0/1k)", "THIN"], ["SALES-PAGE", "TEMPLATE-JUNK", "THIN"]]
    assert each(spark, ["One. Two. One. Three."], lambda c: T.merge_sentences(F.array(c, F.lit(" Two. Four.")))) == ["One. Two. Three. Four."]
    assert each(spark, ["GRI 305-1?", "305-1", "GRI 2", "what is esg"], T.out_of_scope) == [True, True, True, False]
    assert each(spark, ["Straße Ünder-Line 5"], T.squash) == ["straenderline5"]


def test_urls(spark):
    urls = ["https://a.org/x/OP/op-6/", "http://b.org/f/My%20File+1.PDF?q=1#z", "https://c.org", "https://d.org/.hidden"]
    assert each(spark, urls, T.url_extension) == ["", ".pdf", "", ""]
    assert each(spark, urls, T.original_name) == ["(no filename)", "My File+1.PDF", "(no filename)", ".hidden"]
    assert each(spark, urls, T.local_name)[1] == hashlib.sha1(urls[1].encode()).hexdigest()[:16] + ".pdf"
    links = each(spark, ["/a|#x|mailto:b|/a|https://c.org|javascript:d| "], lambda c: T.absolute_links(F.split(c, r"\|"), "https://base"))
    assert links == [["https://base/a", "https://c.org"]]
