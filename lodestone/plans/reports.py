"""Queries of the report path: chart tables, facts, requirements, candidates, safe retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import embedding as E
from lodestone.operators import html as H
from lodestone.operators import measures as M
from lodestone.operators import narrative as N
from lodestone.operators import pages as P
from lodestone.operators import requirements as R
from lodestone.operators import vectors as W
from lodestone.plans.relational import LINES, master
from lodestone.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(LINES + "SELECT k AS o_orderkey, round(o_totalprice, 2) AS score, CASE WHEN k % 4 = 0 THEN NULL ELSE round_even(100 * o_totalprice / 500000, 1) END AS pct_of_max FROM m WHERE anchor")
def bi_scores(spark: SparkSession, d: str) -> DataFrame:
    """A row for each anchored total and its percentage of a maximum, of which some are 0."""
    rows = master(spark, d).withColumn("score", F.col("o_totalprice")).withColumn("max", F.when(F.col("o_orderkey") % 4 == 0, 0).otherwise(500000))
    return M.scores(rows).select("o_orderkey", F.round("score", 2).alias("score"), "pct_of_max")


MEASURES = """
WITH r AS (SELECT n_nationkey AS institution, 'C' || p_size % 20 AS credit, CASE p_partkey % 4 WHEN 0 THEN 'Points earned for ' WHEN 1 THEN 'Energy per person of ' ELSE 'Use of ' END || p_brand AS field, max(l_quantity) AS value_numeric
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
m AS (SELECT p_partkey AS line, 'C' || p_size % 20 AS credit, CASE p_partkey % 4 WHEN 0 THEN 'Points earned for ' WHEN 1 THEN 'Energy per person of ' ELSE 'Use of ' END || p_brand AS field, 'D' || p_partkey % 30 AS disclosure,
  list_value('partial', 'component', 'gap_gri_side', 'equivalent', 'intensity')[p_partkey % 5 + 1] AS relationship, list_value('confirmed', 'confirmed', 'proposed')[p_partkey % 3 + 1] AS review_status FROM part),
k AS (SELECT *, row_number() OVER (PARTITION BY credit, field ORDER BY list_position(['equivalent', 'component', 'intensity', 'partial'], relationship), line) AS nth FROM m WHERE review_status = 'confirmed' AND relationship <> 'gap_gri_side')
"""


def measured(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p, k = table(spark, d, "part"), F.col("p_partkey")
    field = F.concat(F.when(k % 4 == 0, "Points earned for ").when(k % 4 == 1, "Energy per person of ").otherwise("Use of "), F.col("p_brand"))
    credit = F.concat(F.lit("C"), (F.col("p_size") % 20).cast("string"))
    named = p.select("p_partkey", credit.alias("credit"), field.alias("field"))
    sold = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(named, F.col("l_partkey") == k)
    records = sold.groupBy(F.col("s_nationkey").alias("institution"), "credit", "field").agg(F.max("l_quantity").alias("value_numeric")).withColumn("value_type", F.lit("number"))
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (k % n + 1).cast("int"))
    mapping = p.select(
        k.alias("line"), credit.alias("credit"), field.alias("field"), F.lit("S").alias("standard"), F.concat(F.lit("D"), (k % 30).cast("string")).alias("disclosure"),
        pick(5, "partial", "component", "gap_gri_side", "equivalent", "intensity").alias("relationship"), pick(3, "confirmed", "confirmed", "proposed").alias("review_status"),
    )
    return records, mapping


@query(MEASURES + """
SELECT institution, credit, field, value_numeric, disclosure, relationship, disclosure IS NOT NULL AS mapped, contains(field, 'per person') AS is_intensity, count(*) OVER (PARTITION BY credit, field) = (SELECT count(DISTINCT s_nationkey) FROM supplier) AS comparable,
  CASE WHEN institution = 3 AND credit = 'C5' THEN 'under-count' WHEN institution = 4 AND contains(field, 'per person') THEN 'boundary' END AS data_quality
FROM r LEFT JOIN (SELECT credit, field, disclosure, relationship FROM k WHERE nth = 1) USING (credit, field) WHERE NOT starts_with(field, 'Points earned')
""")
def bi_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Measurements with the disclosure that each answers best."""
    records, mapping = measured(spark, d)
    n = table(spark, d, "supplier").select(F.countDistinct("s_nationkey")).first()[0]
    notes = [((F.col("institution") == 3) & (F.col("credit") == "C5"), "under-count"), ((F.col("institution") == 4) & F.contains("field", F.lit("per person")), "boundary")]
    return M.metrics(records, mapping, n, notes=notes).drop("value_type", "standard")


@query(MEASURES + "SELECT line, m.credit, m.field, coalesce(v, '') AS values FROM m LEFT JOIN (SELECT credit, field, string_agg(institution || ': ' || value_numeric::INT, '; ' ORDER BY institution) AS v FROM r GROUP BY 1, 2) x USING (credit, field)")
def review_worksheet(spark: SparkSession, d: str) -> DataFrame:
    """Each crosswalk row with what institutions say there."""
    records, mapping = measured(spark, d)
    return M.review_worksheet(mapping, records.withColumn("value", F.col("value_numeric").cast("int"))).select("line", "credit", "field", "values")


REFERENCES = T.reference_pattern(["305-1"])


@query(MEASURES + """, x AS (SELECT *, 'S' || substr(disclosure, 2)::INT % 4 AS section FROM m WHERE review_status = 'confirmed'), g AS (SELECT DISTINCT section, disclosure FROM x WHERE relationship = 'gap_gri_side'),
u AS (SELECT * FROM x WHERE relationship <> 'gap_gri_side' AND (section, disclosure) NOT IN (SELECT (section, disclosure) FROM g)), e AS (SELECT DISTINCT institution AS entity FROM r),
f AS (SELECT DISTINCT e.entity, section, CASE WHEN value_numeric IS NULL THEN 'unavailable' ELSE 'figure' END AS kind, disclosure, u.credit, u.field FROM u, e LEFT JOIN r ON r.institution = e.entity AND r.credit = u.credit AND r.field = u.field)
SELECT entity, section, kind, count(*) AS n FROM (SELECT entity, section, kind, disclosure, credit, field FROM f UNION ALL SELECT entity, section, 'gap', disclosure, NULL, NULL FROM g, e) GROUP BY 1, 2, 3""")
def facts_bundle(spark: SparkSession, d: str) -> DataFrame:
    """How many facts of each kind each entity's sections have."""
    records, mapping = measured(spark, d)
    sections = mapping.select("disclosure", F.concat(F.lit("S"), (F.substring("disclosure", 2, 9).cast("int") % 4).cast("string")).alias("section")).distinct()
    rows = records.select(F.col("institution").alias("entity"), "credit", "field", F.col("value_numeric").cast("int").cast("string").alias("value"), F.lit("kg").alias("units"), "value_type")
    found = N.facts(sections, mapping.withColumn("rationale", F.lit("none of 5")).withColumn("caveat", F.lit(None).cast("string")), rows, REFERENCES)
    return found.groupBy("entity", "section", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey, substr(sha256('system' || chr(0) || 'prompt ' || o_custkey), 1, 8) AS key, o_custkey % 2 = 0 AS cached FROM orders
""")
def prompt_cache(spark: SparkSession, d: str) -> DataFrame:
    """Which sections the cache has already, by their prompts' keys."""
    asked = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("prompt "), F.col("o_custkey").cast("string")).alias("prompt"))
    cache = asked.where("o_custkey % 2 = 0").select(N.cache_key(F.lit("system"), F.col("prompt")).alias("key"), F.lit("x").alias("prose"), F.lit("m").alias("model"), F.sha2("prompt", 256).alias("prompt_sha256")).distinct()
    have, lack = N.to_write(asked, cache, "system")
    return have.select("o_orderkey", "key", F.lit(True).alias("cached")).unionByName(lack.select("o_orderkey", "key", F.lit(False).alias("cached")))


@query("""
WITH r AS (SELECT p_partkey AS number, CASE WHEN p_partkey % 11 = 0 THEN p_name || '!' ELSE upper(p_name) END AS title FROM part WHERE p_partkey % 13 <> 0), v AS (SELECT p_partkey AS number, p_name AS title FROM part WHERE p_partkey % 17 <> 0)
SELECT r.number, 'title differs' AS finding FROM r JOIN v USING (number) WHERE lower(r.title) <> lower(v.title) UNION ALL SELECT number, 'missing' FROM v WHERE number NOT IN (SELECT number FROM r) UNION ALL SELECT number, 'unlisted' FROM r WHERE number NOT IN (SELECT number FROM v)
""")
def requirement_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    """Where pages and vocabulary disagree."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    pages = p.where(k % 13 != 0).select(k.alias("number"), F.when(k % 11 == 0, F.concat("p_name", F.lit("!"))).otherwise(F.upper("p_name")).alias("title"))
    return R.cross_check(pages, p.where(k % 17 != 0).select(k.alias("disclosure"), F.col("p_name").alias("title")))


@query("""
WITH p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '<p>([^<]+)', 1), lambda t: trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&'), '[\\s\\x{a0}]+', ' ', 'g'))), lambda t: t <> '') AS texts FROM pages),
u AS (SELECT page_id, generate_subscripts(texts, 1) AS nth, unnest(texts) AS t FROM p)
SELECT page_id, nth || '-' || (page_id % 90 + 1) AS number, 'Title of ' || nth AS title, CASE nth % 6 WHEN 0 THEN t || chr(10) || 'a b' WHEN 1 THEN t || '2' WHEN 2 THEN t || 'tail' || chr(10) || 'inner' || chr(10) || 'last' ELSE t END AS text FROM u WHERE nth % 6 < 4
""")
def html_segments(spark: SparkSession, d: str) -> DataFrame:
    """What pages state below each disclosure's heading: the paragraphs of the pages themselves, put into nested markup.

    Headings are plain, spans within spans, or first ranks; texts are in paragraphs, divs and nested items. One in six stands
    below another heading and one below a glossary, so that they are nobody's; headers, footers and what is outside the body are left out.
    Numbers count a page's paragraphs, so they have as many digits as it takes, unlike those of a standard.
    """
    p = table(spark, d, "pages")
    trimmed = F.transform(F.regexp_extract_all("html", F.lit("<p>([^<]+)"), F.lit(1)), lambda t: F.trim(F.regexp_replace(t, r"(?:[ \t\n\f\r\xa0]|&nbsp;)+", " ")))

    def planted(t: F.Column, k: F.Column) -> F.Column:
        n, kind = (k + 1).cast("string"), (k + 1) % 6
        number = F.concat(n, F.lit("-"), (F.col("page_id") % 90 + 1).cast("string"))
        of = lambda *parts: F.concat(*[x if isinstance(x, F.Column) else F.lit(x) for x in parts])
        return (
            F.when(kind == 0, of("<div><span class='big heading'>Disclosure ", number, "<br/>Title of ", n, "</span></div><p>", t, "<div>nobody's</div><p>a <b>b</b>"))
            .when(kind == 1, of('<span class="heading"><span class="heading">Disclosure ', number, '</span><span class="h2"><i>Title of</i> ', n, "</span></span><div><p>", t, "<sub>2</sub></div>"))
            .when(kind == 2, of("<h1>Disclosure ", number, " Title of ", n, "</h1><ol><li>", t, "<ul><li>inner<li><b>last</b></ul>tail</li></ol>"))
            .when(kind == 3, of("<h2 id=x><a>Disclosure ", number, "</a><a>Title of ", n, "</a></h2><ul>not in an item<li><div>", t, "</div></li></ul>"))
            .when(kind == 4, of("<h2>Other ", n, "</h2><p>", t, "</p>"))
            .otherwise(of("<h2>Disclosure ", number, " Title of ", n, "</h2><p>Glossary:</p><p>", t, "</p>"))
        )

    whole = F.concat(
        F.lit("<html><body><header><h2>Disclosure 1-99 No</h2><p>no</p></header><h2>Disclosure 2-99 No</h2><p>no</p><div class='x'><div class=\"wide doc-body\"><div>"),
        F.array_join(F.transform(F.filter(trimmed, lambda t: t != ""), planted), "\n"),
        F.lit("</div><nav><li>no</li></nav><footer><p>no</p></footer></div><p>no</p></div><footer><h2>Disclosure 3-99 No</h2><p>no</p></footer></body></html>"),
    )
    # the markup put around a paragraph, the "<p>" of which is 3, has some 105 code points
    size = F.length("html") + 35 * (F.length("html") - F.length(F.replace("html", F.lit("<p>"), F.lit(""))))
    return R.extract_requirements(p.select("page_id", whole.alias("html"), size.alias("size")), "page_id", "html", size="size", heading=r"^Disclosure ([0-9]+--?[0-9]+) (.+)$")


@query("""
SELECT o_orderkey, 'Report' AS href, 'C-' || o_custkey AS code, round(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 10 + 0.5 END, 1) AS score, 10.0::DOUBLE AS max FROM orders
""")
def scorecard_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of scorecard tables: link, code and the two numbers of a score."""
    from lodestone.functions.values import score_pair

    k = F.col("o_orderkey")
    score = F.when(k % 3 == 0, "").otherwise(F.concat((k % 10).cast("string"), F.lit(".5")))
    html = F.concat(F.lit("<table><tr><th>h</th></tr><tr><td><a href='/Report'>C-"), F.col("o_custkey").cast("string"), F.lit("</a></td><td>"), score, F.lit(" / 10.00</td></tr></table>"))
    rows = H.table_rows(table(spark, d, "orders").select("o_orderkey", html.alias("html")), "o_orderkey", "html").where("href <> ''")
    pair = score_pair(F.col("cells")[1])
    return rows.select("o_orderkey", F.regexp_replace("href", "^/", "").alias("href"), F.col("cells")[0].alias("code"), pair[0].alias("score"), pair[1].alias("max"))


@query("""
WITH f AS (SELECT * FROM (VALUES (1, '6.1 Ind', 'Sec A', 'Field one'), (2, '6.1 Ind', 'Sec A', 'Field two'), (3, '6.2 Other', '', 'Field three'), (4, '6.2 Other', '', 'Field four')) t(nth, indicator, section, field))
SELECT page_id AS institution, 'OP-' || (page_id % 9 + 1) AS credit_code, 'Environmental' AS pillar, 'Name ' || page_id AS credit_name, indicator, section, field,
  CASE nth WHEN 1 THEN '1,23' || page_id % 10 || '.50' WHEN 2 THEN 'Yes indeed d y' ELSE '' END AS value, CASE nth WHEN 1 THEN 'MWh' ELSE '' END AS units, CASE nth WHEN 1 THEN 1230.5e0 + page_id % 10 END AS value_numeric,
  CASE nth WHEN 1 THEN 'number' WHEN 2 THEN 'text' ELSE 'not_reported' END AS value_type, CASE nth WHEN 2 THEN 'https://base.org/doc/' || page_id ELSE '' END AS links FROM pages, f
""")
def parse_fields(spark: SparkSession, d: str) -> DataFrame:
    """The fields of planted pages: headings that carry on, a unit in italics, emphasis, an unanswered title."""
    k = F.col("page_id")
    s = k.cast("string")
    html = F.concat(
        F.lit("<html><script>var x = '<div class=\"well\">no</div>'</script><h1>University of X OP-1: Name "), s, F.lit("</h1><div class='field-header x'><h4>6.1 Ind</h4> <h5>Sec A</h5></div><div class='scorecardFieldTitle'>Field one:</div><p>left out</p>"
        "<div class='well'><div>1,23"), (k % 10).cast("string"), F.lit(".50</div> <i>MWh</i></div>after<span class=\"a scorecardFieldTitle\">Field <b>two</b></span>of it<div class='well well-sm'>Yes <i>indeed</i> <a href='/doc/"), s,
        F.lit("'>d</a> <a href='#x'>y</a></div>after<div class='well-sm'>no well</div><div class='field-header'><h4>6.2 Other</h4></div><div class='scorecardFieldTitle'>Field three</div><div class='scorecardFieldTitle'>Field four</div><div class='well'>---</div>"),
    )
    pages = table(spark, d, "pages").select(k.alias("institution"), F.concat(F.lit("OP-"), (k % 9 + 1).cast("string")).alias("credit_code"), html.alias("html"))
    return P.fields(pages, base="https://base.org").drop("ord", "category")


@query("""
SELECT page_id AS institution, 'Operations' AS category, 'OP' AS category_code, 'OP-' || (page_id % 9 + 1) AS credit_code, 'Credit ' || page_id AS credit_name, 'Complete' AS status, page_id % 7 + 0.5e0 AS score, 8.0e0 AS max FROM pages
UNION ALL SELECT page_id, 'Planning & Administration', 'PA', 'PA-3', 'P', 'Not Applicable', NULL, NULL FROM pages
""")
def parse_scores(spark: SparkSession, d: str) -> DataFrame:
    """The credits of planted scorecards: headings, repeats, other links and unknown categories left out."""
    k = F.col("page_id")
    row = lambda href, name, *cells: f"<tr><td><a href='{href}'>{name}</a></td>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    page = "<table><tr><th>Credit</th><th>Score</th></tr>" + row("/i/x/report/2025/OP/energy/OP-@n/", "Credit @k", " Complete", "@a.50 / 8.00") + row("/i/x/report/2025/OP/energy/OP-@n/", "Again", "x", "1 / 2")
    page += row("/i/x/report/2025/ZZ/e/ZZ-1/", "No", "x", "1 / 2") + row("/about", "About", "1 / 2") + row("/i/report/2025/PA/g/PA-3/", "P", "Not Applicable", " / 4") + "</table>"
    html = F.lit(page)
    for mark, value in (("@n", k % 9 + 1), ("@k", k), ("@a", k % 7)):
        html = F.replace(html, F.lit(mark), value.cast("string"))
    return P.scorecard(table(spark, d, "pages").select(k.alias("institution"), html.alias("html")))


@query("""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, round(list_cosine_similarity(q.v, i.v), 6) AS score FROM e q, e i WHERE q.vec_id % 20 = 0 AND q.vec_id <> i.vec_id)
SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INT AS rank FROM s QUALIFY rank <= 6 AND score >= 0.3
""")
def candidate_join(spark: SparkSession, d: str) -> DataFrame:
    """The best fields for each of a stated set of queries, from a score on."""
    e = table(spark, d, "embeddings")
    queries = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    fields = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"))
    return E.candidates(queries, fields, apart=True, digits=6)


@query("""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label, CASE WHEN vec_id % 3 = 0 THEN 'institution' ELSE 'knowledge' END AS lane, 'U' || vec_id % 6 AS institution, CASE WHEN vec_id % 5 = 0 THEN 'peer_report' ELSE 'framework' END AS kind, CASE WHEN vec_id % 7 = 0 THEN 'fr' ELSE 'en' END AS language FROM embeddings),
s AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, i.lane, round(list_cosine_similarity(q.v, i.v), 6) AS score FROM e q, e i WHERE q.vec_id % 20 = 0 AND ((i.lane = 'institution' AND i.institution = 'U3') OR (i.lane = 'knowledge' AND i.kind <> 'peer_report' AND i.language = 'en'))),
k AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id, lane ORDER BY score DESC, item_id) <= CASE WHEN lane = 'institution' THEN 3 ELSE 2 END)
SELECT query_id, item_id, lane, score FROM k
""")
def safe_retrieve(spark: SparkSession, d: str) -> DataFrame:
    """Retrieval that shows one institution's chunks, no peer reports and one language."""
    e, k = table(spark, d, "embeddings"), F.col("vec_id")
    index = e.select(
        k.alias("item_id"), F.col("embedding").alias("vector"), F.when(k % 3 == 0, "institution").otherwise("knowledge").alias("lane"), F.concat(F.lit("U"), (k % 6).cast("string")).alias("institution"),
        F.when(k % 5 == 0, "peer_report").otherwise("framework").alias("source_type"), F.when(k % 7 == 0, "fr").otherwise("en").alias("language"), F.lit(False).alias("has_quantity"), F.lit("").alias("pillar"),
    )
    queries = e.where("vec_id % 20 = 0").select(k.alias("query_id"), F.col("embedding").alias("query"))
    return W.retrieve(queries, index, k=5, lane="all", institution="U3", min_score=-1.0, digits=6).select("query_id", "item_id", "lane", "score")


@query("""
SELECT user_id % 20 AS credit, event_type AS field, count(DISTINCT user_id) AS n, min(event_id) AS first, left('N' || user_id % 20 || '. ' || event_type || '. ' || arg_min(floor(value)::INT, event_id), 300) AS text FROM events WHERE value > 20 GROUP BY 1, 2
""")
def field_corpus(spark: SparkSession, d: str) -> DataFrame:
    """A field's first populated value, how many report it, and the text that stands for it in a search."""
    e = table(spark, d, "events")
    value = F.when(F.col("value") > 20, F.floor("value").cast("int").cast("string")).otherwise(" ")
    rows = e.select((F.col("user_id") % 20).alias("credit"), F.col("event_type").alias("field"), F.col("user_id").alias("institution"), value.alias("value"), F.concat(F.lit("N"), (F.col("user_id") % 20).cast("string")).alias("credit_name"), F.col("event_id").alias("ord"))
    first = rows.where("trim(value) <> ''").groupBy("credit", "field").agg(F.min("ord").alias("first"))
    return E.field_corpus(rows).join(first, ["credit", "field"]).select("credit", "field", F.col("n_institutions").alias("n"), "first", "text")


@query("""
SELECT coalesce(CASE WHEN doc_id % 31 = 0 THEN 'spreadsheet' WHEN doc_id % 29 = 0 THEN 'empty' END, 'ok') AS status, count(*) AS documents, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1
""")
def status_counters(spark: SparkSession, d: str) -> DataFrame:
    """What was kept and skipped, by reason, in one aggregation."""
    status = F.when(F.col("doc_id") % 31 == 0, "spreadsheet").when(F.col("doc_id") % 29 == 0, "empty").otherwise("ok")
    return table(spark, d, "documents").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars"))
