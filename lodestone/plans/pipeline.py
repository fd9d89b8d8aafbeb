"""Queries over the flows that users run: content index, reconciliation, corpus chunks, lexical index, reports as HTML, many references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import flows
from lodestone.functions import markdown as M
from lodestone.functions import text as T
from lodestone.functions.sizes import dealt_out
from lodestone.functions.stages import passing_folder, written
from lodestone.operators import embedding as E
from lodestone.operators import writing as W
from lodestone.operators.references import References
from lodestone.plans.disclosures import STAR, star
from lodestone.plans.texts import CHUNKS, STOP, TERMS
from lodestone.sources import files
from lodestone.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def disclosed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The master table, mapping, vocabulary and institutions of the flows, over the driver's tables."""
    vocabulary, mapping, entities, records = star(spark, d)
    name = F.concat(F.lit("U"), F.col("entity").cast("string"))
    joined = records.select(name.alias("institution"), F.col("credit").alias("credit_code"), "field", "value", F.lit("t").alias("units"), F.lit("number").alias("value_type"), F.lit(True).alias("has_detail"))
    line = F.substring("field", 6, 20).cast("long")
    rows = mapping.select(
        line.alias("line"), F.col("credit").alias("stars_credit"), F.col("field").alias("stars_field"), F.lit("S").alias("gri_standard"), F.col("disclosure").alias("gri_disclosure"), "relationship", "review_status",
        F.lit("why").alias("rationale"), F.when(line % 3 == 0, F.concat(F.lit("Mind it. See "), (line % 7).cast("string"), F.lit("."))).alias("caveat"),
    )
    return joined, rows, vocabulary.withColumn("title", F.concat(F.lit("T "), F.col("disclosure"))), entities.select(name.alias("institution"))


@query(STAR + """, lined AS (SELECT *, substr(field, 6)::BIGINT AS line, CASE WHEN substr(field, 6)::BIGINT % 3 = 0 THEN 'Mind it. See ' || substr(field, 6)::BIGINT % 7 || '.' END AS caveat FROM m),
t AS (SELECT entity, disclosure, list('**' || field || '**: ' || value || ' t' ORDER BY credit, field) FILTER (populated) AS a, list(credit || ' / ' || field ORDER BY credit, field) FILTER (NOT populated) AS b FROM h GROUP BY 1, 2),
w AS (SELECT disclosure, unnest(['Mind it.', 'See ' || line % 7 || '.']) AS part, line, unnest([1, 2]) AS nth FROM lined WHERE review_status = 'confirmed' AND caveat IS NOT NULL),
y AS (SELECT disclosure, string_agg(part, ' ' ORDER BY pos, nth) AS caveats FROM (SELECT disclosure, part, min(line) AS pos, min(nth) AS nth FROM w GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT disclosure, arg_min(coalesce(caveat, ''), line) AS caveat FROM lined WHERE review_status = 'confirmed' AND relationship = 'gap_gri_side' GROUP BY 1),
j AS (SELECT disclosure, arg_min(coalesce(caveat, ''), line) AS caveat, arg_min(credit || ' / ' || field, line) AS name FROM lined WHERE review_status = 'rejected' GROUP BY 1)
SELECT 'U' || s.entity AS entity, row_number() OVER (PARTITION BY s.entity ORDER BY s.standard, s.disclosure)::INT AS place, s.standard, s.disclosure, 'T ' || s.disclosure AS title,
  CASE WHEN c.confirmed = 0 AND c.rejected = 0 THEN 'Not assessed' ELSE s.status END AS status,
  CASE WHEN g.disclosure IS NOT NULL THEN 'No data exists for this disclosure.' WHEN c.confirmed = 0 AND j.disclosure IS NOT NULL THEN 'Assessed: the nearest field (' || j.name || ') was reviewed and rejected as an answer to this disclosure.' ELSE coalesce(array_to_string(a, '<br>'), '') END AS detail,
  CASE WHEN g.disclosure IS NOT NULL THEN g.caveat WHEN c.confirmed = 0 AND j.disclosure IS NOT NULL THEN j.caveat ELSE concat_ws(' ', y.caveats, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 'Not populated by this institution: ' || array_to_string(b[1:3], '; ') || '.' END) END AS note
FROM s JOIN c USING (entity, standard, disclosure) LEFT JOIN t ON t.entity = s.entity AND t.disclosure = s.disclosure LEFT JOIN y ON y.disclosure = s.disclosure LEFT JOIN g ON g.disclosure = s.disclosure LEFT JOIN j ON j.disclosure = s.disclosure
""")
def flow_content_index(spark: SparkSession, d: str) -> DataFrame:
    """The content index as the flow gives it: status, detail and note of each institution's disclosures, in their order."""
    rows, _ = flows.content_index(*disclosed(spark, d))
    return rows


@query("""
WITH a AS (SELECT c_custkey AS k, c_acctbal AS score FROM customer WHERE c_custkey % 3 > 0), b AS (SELECT o_custkey AS k FROM orders WHERE o_orderkey % 2 = 0)
SELECT 'orphan fields' AS "check", 0::DOUBLE AS expected, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a))::DOUBLE AS actual UNION ALL SELECT 'field rows', (SELECT count(*) FROM b)::DOUBLE, (SELECT count(*) FROM b)::DOUBLE
UNION ALL SELECT 'anchors', (SELECT count(*) FROM a)::DOUBLE, (SELECT count(*) FROM a)::DOUBLE UNION ALL SELECT 'anchored score', round((SELECT sum(score) FROM a), 2), round((SELECT sum(score) FROM a), 2)
""")
def flow_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """What a joined table has against its sides, as the flow checks it: fields without a credit are found, nothing else differs."""
    code = lambda c: F.concat(F.lit("C-"), F.col(c).cast("string")).alias("credit_code")
    scores = table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.lit("U").alias("institution"), code("c_custkey"), F.col("c_acctbal").alias("score"))
    fields = table(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.lit("U").alias("institution"), code("o_custkey"), F.col("o_orderpriority").alias("section"), F.col("o_orderkey").cast("string").alias("field"), F.col("o_orderstatus").alias("value"))
    found = flows.reconciliation(scores, fields, flows.master(scores, fields))
    return found.select("check", F.round("expected", 2).alias("expected"), F.round("actual", 2).alias("actual"))


@query(CHUNKS + """
SELECT 'doc-' || doc_id || '-' || chunk_index AS id, sha1(chunk) AS sha, 'knowledge' AS lane, 'doc-' || doc_id AS source, 'https://x/' || doc_id AS url, CASE WHEN doc_id = 7 THEN 'framework' ELSE 'context' END AS source_type,
  CASE WHEN doc_id % 4 = 1 THEN 'fr' ELSE 'en' END AS language, CASE WHEN doc_id % 4 = 1 THEN 'FRENCH THIN' WHEN doc_id % 4 = 2 THEN 'THIN' ELSE '' END AS scraper_flags, chunk_index::INT AS chunk_index, length(chunk) AS chars FROM c
""")
def flow_corpus_chunks(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of a corpus with what searches filter by, as the flow makes them: kinds of sources, languages by the flags of pages."""
    k = F.col("doc_id")
    corpus = table(spark, d, "documents").select(F.concat(F.lit("doc-"), k.cast("string")).alias("source"), F.concat(F.lit("https://x/"), k.cast("string")).alias("url"), F.col("text").alias("body"))
    flags = table(spark, d, "documents").where("doc_id % 4 in (1, 2)").select(F.concat(F.lit("doc-"), k.cast("string")).alias("source"), F.when(k % 4 == 1, "FRENCH THIN").otherwise("THIN").alias("flags"))
    rows = flows.corpus_chunks(corpus, flags, {"doc-7": "framework"})
    return rows.select("id", F.sha1("text").alias("sha"), "lane", "source", "url", "source_type", "language", "scraper_flags", "chunk_index", "chars")


@query(TERMS + "SELECT d.doc_id AS item_id, count(w.term) AS terms, round(coalesce(sum(w.w * w.w), 0), 6) AS norm, 'tfidf' AS backend FROM documents d LEFT JOIN w ON w.doc_id = d.doc_id GROUP BY 1")
def lexical_index(spark: SparkSession, d: str) -> DataFrame:
    """An index of all documents by the backend that is always there: a map of weights for each, of length 1, and the backend's name."""
    chunks = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    index = flows.built_index(chunks, E.LexicalEmbedder.fit(chunks, "id", "text"))
    norm = F.aggregate(F.map_values("vector"), F.lit(0.0), lambda s, w: s + w * w)
    return index.select("item_id", F.size("vector").cast("long").alias("terms"), F.round(norm, 6).alias("norm"), "backend")


@query("""
SELECT p_partkey, '<h2>Part ' || p_partkey || ' <em>' || replace(p_brand, '#', '#') || '</em></h2>' || chr(10) || '<p>Made by <strong>' || p_brand || '</strong> &amp; others, 5 &lt; 6,' || chr(10) || 'of <code>' || p_type || '*</code>. <a href="https://x/' || p_partkey || '_a?b=1&amp;c">See</a> *it*</p>' || chr(10)
  || '<ul><li>one</li>' || chr(10) || '<li>' || p_name || '</li></ul>' || chr(10) || '<ol><li>first</li></ol>' || chr(10) || '<table><thead><tr><th>Name</th><th>Size</th></tr></thead>' || chr(10) || '<tbody><tr><td>' || p_name || ' | ' || p_brand || '</td><td>' || p_size || '</td></tr>' || chr(10)
  || '<tr><td>a<br>b</td><td></td></tr></tbody></table>' || chr(10) || '<hr>' AS html FROM part
""")
def markdown_html(spark: SparkSession, d: str) -> DataFrame:
    """A report of each kind of block for each part, as HTML."""
    p, k = dealt_out(table(spark, d, "part"), 5_000), F.col("p_partkey").cast("string")
    lines = F.array(
        F.concat(F.lit("## Part "), k, F.lit(" *"), F.col("p_brand"), F.lit("*")), F.lit(""), F.concat(F.lit("Made by **"), F.col("p_brand"), F.lit("** & others, 5 < 6,")), F.concat(F.lit("of `"), F.col("p_type"), F.lit("*`. [See](https://x/"), k, F.lit("_a?b=1&c) \\*it\\*")),
        F.lit("- one"), F.concat(F.lit("* "), F.col("p_name")), F.lit(""), F.lit("1. first"), F.lit(""), F.lit("| Name | Size |"), F.lit("|:--|--:|"), F.concat(F.lit("| "), F.col("p_name"), F.lit(" \\| "), F.col("p_brand"), F.lit(" | "), F.col("p_size").cast("string"), F.lit(" |")),
        F.lit("| a<br>b | |"), F.lit(""), F.lit("---"),
    )
    return p.select("p_partkey", M.to_html(F.array_join(lines, "\n")).alias("html"))


@query("""
WITH n AS (SELECT DISTINCT p_size || '-' || p_partkey % 40 AS number FROM part), t AS (SELECT o_orderkey, (o_orderkey % 50 + 1) || '-' || o_custkey % 45 AS a, (o_custkey % 50 + 1) || '-' || o_orderkey % 45 AS b FROM orders),
k AS (SELECT *, a IN (SELECT number FROM n) AS first, b IN (SELECT number FROM n) AS second FROM t)
SELECT o_orderkey, CASE WHEN first AND second THEN 'GRI ' || a || ', ' || b WHEN first THEN 'GRI ' || a || ', [figure]-[figure]' ELSE 'GRI [figure]-[figure] [figure]-[figure]' END || ' and Disclosure ' || CASE WHEN second THEN b ELSE '[figure]-[figure]' END || ': [figure] t of Scope 2 and 3.' AS text FROM k
""")
def many_references(spark: SparkSession, d: str) -> DataFrame:
    """Figures blanked out of texts that cite a large vocabulary: what isn't one of its numbers is a figure."""
    listed = table(spark, d, "part").select(F.concat_ws("-", F.col("p_size").cast("string"), (F.col("p_partkey") % 40).cast("string")).alias("number")).distinct()
    found = References(spark, [r[0] for r in listed.limit(100_000).collect()])  # sizes and remainders: at most 2,000
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pair = lambda a, b: F.concat_ws("-", (a % 50 + 1).cast("string"), (b % 45).cast("string"))
    text = F.concat(F.lit("GRI "), pair(k, c), F.lit(", "), pair(c, k), F.lit(" and Disclosure "), pair(c, k), F.lit(": "), F.format_string("%.2f", "o_totalprice"), F.lit(" t of Scope 2 and 3."))
    return table(spark, d, "orders").select("o_orderkey", T.redact_figures(text, found).alias("text"))


class Unsteady:
    """Fails as often as its prompt says, then writes; after five times it would give up."""

    name = model = "unsteady"

    def __init__(self) -> None:
        self.failed: dict[str, int] = {}

    def write(self, system: str, prompt: str, tokens: list[str]) -> str:
        n = self.failed.get(prompt, 0)
        if n < int(prompt.rsplit(" ", 1)[1]):
            self.failed[prompt] = n + 1
            raise W.Busy("not now")
        return f"{prompt.rsplit(' ', 1)[0]}: {', '.join(tokens)}"


@query("""
SELECT 'k' || s_suppkey AS key, CASE WHEN s_suppkey % 6 < 4 THEN s_name || ': a, t' || s_suppkey END AS prose, CASE WHEN s_suppkey % 6 < 4 THEN 'written' ELSE 'failed' END AS status, least(s_suppkey % 6 + 1, 4)::INT AS calls,
  CASE WHEN s_suppkey % 6 = 0 THEN 0.0 WHEN s_suppkey % 6 = 1 THEN 2.0 WHEN s_suppkey % 6 = 2 THEN 6.0 ELSE 14.0 END::DOUBLE AS waited FROM supplier
""")
def prompt_calls(spark: SparkSession, d: str) -> DataFrame:
    """What a writer that is often busy makes of a prompt for each supplier: how many calls each took, and how long it would have waited."""
    k = F.col("s_suppkey")
    asked = table(spark, d, "supplier").select(F.concat(F.lit("k"), k.cast("string")).alias("key"), F.concat_ws(" ", "s_name", (k % 6).cast("string")).alias("prompt"), F.array(F.lit("a"), F.concat(F.lit("t"), k.cast("string"))).alias("tokens"))
    limits = W.Limits(per_day=10_000_000, pace=0, attempts=4, backoff=2, jitter=0, writers=8)
    with passing_folder(spark, "prompt_calls") as at:
        return W.write_prompts(asked, Unsteady, "system", W.Ledger(at), limits, wait=lambda _: None).select("key", "prose", "status", "calls", "waited")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name || ' (' || s_nationkey || ') of two' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE chr(10) || 'below it' END END AS text, CASE WHEN s_suppkey % 5 = 0 THEN 'failed: PdfError' ELSE 'ok' END AS status FROM supplier
""")
def pdf_files(spark: SparkSession, d: str) -> DataFrame:
    """A PDF for each supplier, of two columns and a line below them, written into archives and read back; one in five has no catalog and is a status."""
    k = F.col("s_suppkey")
    shown = F.concat(F.lit("BT /F1 10 Tf 50 700 Td ("), F.col("s_name"), F.lit(" \\("), F.col("s_nationkey").cast("string"), F.lit("\\)) Tj 300 0 Td (of two) Tj "), F.when(k % 3 == 0, "").otherwise("-300 -14 Td [(be) 20 (low) -400 (it)] TJ "), F.lit("ET"))
    fonts = "4 0 obj << /Type /Font /Subtype /Type1 /Encoding /WinAnsiEncoding >> endobj"
    pages = f"2 0 obj << /Type /Pages /Kids [3 0 R] >> endobj 3 0 obj << /Type /Page /Parent 2 0 R /Resources << /Font << /F1 4 0 R >> >> /Contents 5 0 R >> endobj {fonts}"
    body = F.concat(F.lit("5 0 obj << /Length "), F.length(shown).cast("string"), F.lit(" >> stream\n"), shown, F.lit("\nendstream endobj"))
    catalog = F.when(k % 5 == 0, "").otherwise("1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj")
    name = F.concat(F.lit("at="), F.coalesce(k.cast("string"), F.lit("")), F.lit(".pdf"))
    with passing_folder(spark, "pdf_files") as at:
        files.write_archives(table(spark, d, "supplier").select(name.alias("name"), F.concat_ws("\n", F.lit("%PDF-1.4"), catalog, F.lit(pages), body, F.lit("%%EOF\n")).cast("binary").alias("content")), at)
        found = files.extract_documents(spark, at, least=1, archives=True)
        lines = F.transform(F.split("text", "\n"), lambda s: F.trim(F.regexp_replace(s, " +", " ")))
        return written(found.select(F.regexp_extract("file", r"/at=(-?\d*)\.pdf$", 1).try_cast("long").alias("s_suppkey"), F.array_join(lines, "\n").alias("text"), "status"))


@query(TERMS + f""", qc AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9-]+')) AS term FROM benchmark) WHERE term NOT IN ('{STOP}') GROUP BY 1, 2),
qr AS (SELECT item_id, term, (1 + ln(tf)) * idf AS w FROM qc JOIN f USING (term)), q AS (SELECT item_id, term, w / greatest(sqrt(sum(w * w) OVER (PARTITION BY item_id)), 1e-12) AS w FROM qr),
x AS (SELECT item_id, doc_id, round(sum(q.w * w.w), 6) AS score FROM q JOIN w USING (term) GROUP BY 1, 2),
s AS (SELECT * FROM x WHERE doc_id % 3 > 0 AND doc_id % 5 <> 1 AND doc_id % 4 > 0 AND doc_id % 7 > 0), e AS (SELECT *, 'U' || doc_id % 2 AS entity FROM x WHERE doc_id % 3 = 0),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS nth FROM s QUALIFY nth <= 3), n AS (SELECT item_id, entity, doc_id, score, row_number() OVER (PARTITION BY item_id, entity ORDER BY score DESC, doc_id) AS nth FROM e QUALIFY nth <= 4)
SELECT u.v AS entity, item_id AS section, 'style' AS kind, lpad(nth::VARCHAR, 3, '0') AS nth, 'd' || doc_id AS source FROM k, (VALUES ('U0'), ('U1')) u(v) WHERE score >= 0.1
UNION ALL SELECT entity, item_id, 'evidence', lpad(nth::VARCHAR, 3, '0'), 'd' || doc_id FROM n WHERE score >= 0.1
""")
def section_passages(spark: SparkSession, d: str) -> DataFrame:
    """What a section of each entity gets to read: its own documents' best as evidence, others' best as style, never peers', other languages' or quantities'."""
    k = F.col("doc_id")
    own = k % 3 == 0
    chunks = table(spark, d, "documents").select(
        k.alias("id"), "text", F.concat(F.lit("d"), k.cast("string")).alias("source"), F.when(own, "institution").otherwise("knowledge").alias("lane"), F.when(own, F.concat(F.lit("U"), (k % 2).cast("string"))).otherwise("").alias("institution"),
        F.when(k % 5 == 1, "peer_report").otherwise("framework").alias("source_type"), F.when(k % 4 == 0, "fr").otherwise("en").alias("language"), (k % 7 == 0).alias("has_quantity"), F.lit("").alias("pillar"),
    )
    sections = table(spark, d, "benchmark").select(F.col("item_id").alias("section"), F.col("text").alias("title"))
    entities = spark.createDataFrame([("U0",), ("U1",)], "entity string")
    found = flows.lexical_passages(sections, entities, chunks, T.reference_pattern(["305-1"]), least=0.1, digits=6)
    source = F.regexp_extract("text", r"^\[([^\]]*)\] ", 1)
    return found.select("entity", "section", "kind", F.col("disclosure").alias("nth"), source.alias("source"))
