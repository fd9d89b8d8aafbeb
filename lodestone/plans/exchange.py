"""Queries that go through files: what the writers write and the readers read back, beside the same rows in SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import flows
from lodestone.functions import fixed as X
from lodestone.functions import text as T
from lodestone.functions.stages import passing_folder, written
from lodestone.operators import joins as J
from lodestone.operators import narrative as N
from lodestone.sources import files, schemas, sinks
from lodestone.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def through_files(sql: str):
    """A query that writes files below a folder and reads them back; its rows are written to the shared folder, so that the files can go."""

    def add(f):
        @functools.wraps(f)
        def run(spark: SparkSession, d: str) -> DataFrame:
            with passing_folder(spark, f.__name__) as at:
                return written(f(spark, d, at))

        return query(sql)(run)

    return add


def number(c: str, n: int) -> F.Column:
    return (F.col(c) % n).cast("string")


@through_files("""
SELECT c_name AS institution, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a "b", c' WHEN 2 THEN 'two' || chr(10) || 'lines' ELSE c_mktsegment END AS category,
  'OP-' || c_custkey AS credit_code, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '---' END AS status, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS score FROM customer
""")
def csv_round_trip(spark: SparkSession, d: str, at: str) -> DataFrame:
    """A delimited file as written and read: quotes, separators, line breaks and marks of missing values."""
    k = F.col("c_custkey")
    category = F.when(k % 4 == 0, "None").when(k % 4 == 1, 'a "b", c').when(k % 4 == 2, "two\nlines").otherwise(F.col("c_mktsegment"))
    rows = table(spark, d, "customer").select(
        F.col("c_name").alias("institution"), category.alias("category"), F.lit("OP").alias("category_code"), F.concat(F.lit("OP-"), k.cast("string")).alias("credit_code"), F.lit("n").alias("credit_name"),
        F.when(k % 5 == 0, "N/A").otherwise("---").alias("status"), F.when(k % 3 == 0, "null").otherwise(F.col("c_acctbal").cast("string")).alias("score"), F.lit("10").alias("max"),
    )
    sinks.write_csv(rows, at)
    return files.read_csv(spark, at, schemas.SCORES).select("institution", "category", "credit_code", "status", "score")


@through_files("SELECT 'd-' || doc_id AS id, text, lang AS language, n_chars AS chars, doc_id % 2 = 0 AS has_quantity FROM documents")
def json_lines_round_trip(spark: SparkSession, d: str, at: str) -> DataFrame:
    """All documents as JSON lines, written and read by the declared shape."""
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(F.concat(F.lit("d-"), k.cast("string")).alias("id"), "text", F.col("lang").alias("language"), F.col("n_chars").alias("chars"), (k % 2 == 0).alias("has_quantity"), F.lit(1).alias("extra"))
    sinks.write_json_lines(rows, at)
    return files.read_json_lines(spark, at, schemas.CHUNK).select("id", "text", "language", "chars", "has_quantity")


@through_files(f"""
SELECT n_name AS source, CASE WHEN n_nationkey % 2 = 0 THEN 'https://x/' || n_nationkey ELSE '' END AS url, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'Body of ' || n_name || chr(10) || '{X.HEADER_RULE}' || chr(10) || 'more' END AS body FROM nation
""")
def corpus_files(spark: SparkSession, d: str, at: str) -> DataFrame:
    """A file for each nation, read as a corpus: header above a rule, body below; without a rule there is no body."""
    k = F.col("n_nationkey")
    head = F.concat(F.lit("SOURCE: "), F.col("n_name"), F.when(k % 2 == 0, F.concat(F.lit("\nURL: https://x/"), k.cast("string"))).otherwise(""))
    body = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit(f"\n{X.HEADER_RULE}\n\nBody of "), F.col("n_name"), F.lit(f"\n{X.HEADER_RULE}\nmore\n")))
    table(spark, d, "nation").select(k.alias("at"), F.concat(head, body).alias("value")).write.partitionBy("at").text(at)
    return files.read_corpus(spark, at)


@through_files("SELECT r_name AS standard, 'T ' || r_name AS standard_title, 'F' AS family, '3-' || n_nationkey AS disclosure, n_name AS title FROM nation JOIN region ON n_regionkey = r_regionkey")
def vocabulary_json(spark: SparkSession, d: str, at: str) -> DataFrame:
    """A nested vocabulary of one JSON document, as rows."""
    rows = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    listed = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("3-"), F.col("n_nationkey").cast("string")), F.col("n_name"))))
    each = rows.groupBy("r_name").agg(F.struct(F.concat(F.lit("T "), F.col("r_name")).alias("title"), F.lit("F").alias("family"), listed.alias("disclosures")).alias("body"))
    whole = each.agg(F.map_from_entries(F.collect_list(F.struct("r_name", "body"))).alias("standards"))
    whole.select(F.to_json(F.struct("standards"))).write.text(at)
    return files.read_vocabulary(spark, at)


@through_files("SELECT '305-' || n_nationkey AS number, n_name AS title, 'S' || n_regionkey AS standard, 'line one' || chr(10) || 'of \"' || n_name || '\"' AS text, 'https://x/' || n_nationkey AS source_url FROM nation")
def requirements_json(spark: SparkSession, d: str, at: str) -> DataFrame:
    """Requirements written as one JSON document with a preamble, and read back."""
    k = F.col("n_nationkey").cast("string")
    text = F.concat(F.lit('line one\nof "'), F.col("n_name"), F.lit('"'))
    rows = table(spark, d, "nation").select(F.concat(F.lit("305-"), k).alias("number"), F.col("n_name").alias("title"), F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("standard"), text.alias("text"), F.concat(F.lit("https://x/"), k).alias("source_url"))
    sinks.write_requirements(rows, at, ["what this is", "and whose"], "2025-01-01")
    return files.read_requirements(spark, at).drop("cached_source")


@through_files("SELECT vec_id AS item_id, round(embedding[1]::DOUBLE, 6) AS first, 'L' || label AS label FROM embeddings WHERE vec_id % 3 = 0")
def index_by_lane(spark: SparkSession, d: str, at: str) -> DataFrame:
    """One lane of a vector index as written: its folder alone is read."""
    lane = F.when(F.col("vec_id") % 3 == 0, "institution").otherwise("knowledge")
    sinks.write_index(table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("label"), lane.alias("lane")), at)
    return spark.read.parquet(at).where("lane = 'institution'").select("item_id", F.round(F.col("vector")[0].cast("double"), 6).alias("first"), "label")


@through_files("SELECT 'published' AS place, o_orderkey FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'preview', o_orderkey FROM orders WHERE o_orderkey % 2 = 1")
def guarded_rewrite(spark: SparkSession, d: str, at: str) -> DataFrame:
    """What is published and what is kept aside, after a set that is whole, one that isn't, and one that isn't and has a preview."""
    keys = table(spark, d, "orders").select("o_orderkey")
    even = {"even keys": lambda df: not df.where("o_orderkey % 2 = 1").limit(1).count()}
    sinks.guarded_write(keys.where("o_orderkey % 2 = 0"), f"{at}/out", even)
    try:
        sinks.guarded_write(keys, f"{at}/out", even)
    except sinks.Incomplete:
        pass
    aside = sinks.guarded_write(keys.where("o_orderkey % 2 = 1"), f"{at}/out", even, f"{at}/preview")
    return sinks.read_published(spark, f"{at}/out").select(F.lit("published").alias("place"), "o_orderkey").unionByName(sinks.read_published(spark, aside).select(F.lit("preview").alias("place"), "o_orderkey"))


@query("""
WITH t AS (SELECT n_regionkey, '| Key | Name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || '\\|x |', chr(10) ORDER BY n_nationkey DESC) AS markdown FROM nation GROUP BY 1)
SELECT '# Report' || chr(10) || chr(10) || string_agg('Table of ' || n_regionkey || chr(10) || markdown, chr(10) || chr(10) ORDER BY n_regionkey) AS report FROM t
""")
def markdown_report(spark: SparkSession, d: str) -> DataFrame:
    """A Markdown table for each region, assembled into a report without the first lines of each part."""
    n = table(spark, d, "nation").select("n_regionkey", F.col("n_nationkey").alias("Key"), F.concat("n_name", F.lit("|x")).alias("Name"), (-F.col("n_nationkey")).alias("_at"))
    tables = sinks.markdown_tables(n, ["n_regionkey"], ["_at"], ["Key", "Name"])
    head = F.concat(F.lit("one\ntwo\nthree\nfour\nTable of "), F.col("n_regionkey").cast("string"), F.lit("\n"))
    parts = F.array_sort(F.collect_list(F.struct("n_regionkey", F.concat(head, F.col("markdown")).alias("text"))))
    return tables.agg(sinks.assembled(F.transform(parts, lambda p: p["text"]), F.lit("# Report")).alias("report"))


def judged(spark: SparkSession, d: str) -> DataFrame:
    """Parts as rows of a mapping with each relationship, review state and some caveats."""
    k = F.col("p_partkey")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (k % n + 1).cast("int"))
    return table(spark, d, "part").select(k.alias("line"), pick(5, *X.RELATIONSHIPS[:5]).alias("relationship"), pick(3, *X.REVIEW_STATES).alias("review_status"), F.when(k % 5 == 3, "mind this").alias("caveat"))


@query("""
SELECT p_partkey AS line, p_partkey % 5 = 3 AS partial, w.v AS with_partial FROM part, (VALUES (false), (true)) w(v) WHERE p_partkey % 3 = 1 AND (p_partkey % 5 < 3 OR (w.v AND p_partkey % 5 = 3))
""")
def publishable_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a mapping that may be printed, without and with partial ones."""
    both = [J.publishable(judged(spark, d), v).select("line", (F.col("relationship") == "partial").alias("partial"), F.lit(v).alias("with_partial")) for v in (False, True)]
    return both[0].unionByName(both[1])


@query("SELECT doc_id, sha256(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) AS squashed FROM documents")
def squash_text(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each text's letters and digits, by which wordings are compared."""
    return table(spark, d, "documents").select("doc_id", F.sha2(T.squash(F.col("text")), 256).alias("squashed"))


@query("SELECT trim(p_brand) || chr(31) || coalesce(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type END, '') AS key, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_row_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys that more than one row states; blanks around a part don't count, null is empty."""
    p = table(spark, d, "part").select(F.concat(F.when(F.col("p_partkey") % 2 == 0, " ").otherwise(""), F.col("p_brand")).alias("a"), F.when(F.col("p_size") % 7 != 0, F.col("p_type")).alias("b"))
    return J.repeated_keys(p, ["a", "b"])


PARTS = """
WITH m AS (SELECT p_partkey AS k, trim(repeat(CASE WHEN p_partkey % 11 = 0 THEN 'same ' ELSE p_name || p_partkey || ' ' END, 12)) AS text, p_name || list_value('.docx', '.xlsx', '.txt')[p_partkey % 3 + 1] AS name, p_partkey % 3 = 1 AS sheet FROM part),
s AS (SELECT *, CASE WHEN sheet THEN 'spreadsheet' WHEN row_number() OVER (PARTITION BY sheet, text ORDER BY k) > 1 THEN 'duplicate' END AS skipped FROM m WHERE k % 13 <> 0)
"""


def manifest(spark: SparkSession, d: str) -> DataFrame:
    """Parts as extracted documents of two institutions and an unknown one; some failed."""
    k = F.col("p_partkey")
    text = F.trim(F.repeat(F.when(k % 11 == 0, "same ").otherwise(F.concat("p_name", k.cast("string"), F.lit(" "))), F.lit(12)))
    extension = F.element_at(F.array(*map(F.lit, (".docx", ".xlsx", ".txt"))), (k % 3 + 1).cast("int"))
    return table(spark, d, "part").select(
        k.alias("ord"), F.concat(F.lit("Uni "), number("p_partkey", 3)).alias("institution"), F.concat("p_name", extension).alias("original_name"), F.concat(F.lit("file"), k.cast("string"), extension).alias("local_file"), F.lit("https://x").alias("url"),
        F.lit("OP-1").alias("credit_code"), F.lit("f").alias("field"), F.when(k % 13 == 0, "failed").otherwise("ok").alias("extract_status"), text.alias("text"),
    )


KNOWN = "Uni 0", "Uni 1"


@query(PARTS + """
SELECT 'doc::' || (k % 3) || '::' || left('file' || k || list_value('.docx', '.xlsx', '.txt')[k % 3 + 1], 12) || '::0000' AS id, name || chr(10) || text AS text, 'Uni ' || (k % 3) AS institution, left(name, 80) AS source,
  length(text) AS chars, len(string_split(text, ' ')) AS words FROM s WHERE skipped IS NULL AND k % 3 < 2 AND length(text) >= 120
""")
def institution_lane(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the documents of known institutions, which begin with the document's name; the counts are without it."""
    known = spark.createDataFrame([(n[-1], n) for n in KNOWN], "institution_key string, institution string")
    return flows.document_chunks(manifest(spark, d), known).select("id", "text", "institution", "source", F.col("chars").cast("long").alias("chars"), F.col("words").cast("long").alias("words"))


@query(PARTS + "SELECT coalesce(skipped, 'indexed') AS outcome, count(*) AS documents FROM s GROUP BY 1")
def lane_counters(spark: SparkSession, d: str) -> DataFrame:
    """How many extracted documents are indexed, or left out and why."""
    return flows.document_outcomes(manifest(spark, d))


@query("""
SELECT n_regionkey AS entity, 'S' AS section, '# Title — ' || n_regionkey || chr(10) || string_agg(CASE WHEN n_nationkey % 2 = 0 THEN 'FIGURE' ELSE 'GAP' END || ' 3-' || n_nationkey || ' (C / ' || n_name || '): ' || CASE WHEN n_nationkey % 2 = 0 THEN '{{ t' || n_nationkey || ' }}' ELSE 'why' END, chr(10) ORDER BY n_nationkey % 2, '3-' || n_nationkey) AS prompt FROM nation GROUP BY 1
""")
def prompt_lines(spark: SparkSession, d: str) -> DataFrame:
    """A section's prompt: figures by token and never by value, gaps with their reason."""
    k = F.col("n_nationkey")
    even, n = k % 2 == 0, k.cast("string")
    found = table(spark, d, "nation").select(
        F.col("n_regionkey").alias("entity"), F.lit("S").alias("section"), F.when(even, "figure").otherwise("gap").alias("kind"), F.concat(F.lit("3-"), n).alias("disclosure"), F.lit("C").alias("credit"), F.col("n_name").alias("field"),
        F.when(even, F.concat(F.lit("t"), n)).alias("token"), F.when(even, "123").otherwise("why").alias("text"),
    )
    return N.prompts(found, spark.createDataFrame([("S", "Title")], "section string, title string"))


@query("""
SELECT o_orderkey, 'Total ' || (o_orderkey % 50 + 10) || ' t' || CASE o_orderkey % 3 WHEN 0 THEN ', up 77 percent.' WHEN 1 THEN ', see 2019.' ELSE '.' END AS rendered, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 50 + 10 <> 77 THEN ['77'] ELSE [] END AS invented,
  CASE WHEN o_orderkey % 3 = 1 THEN ['2019'] ELSE [] END AS review, o_orderkey % 3 <> 0 AS publishable FROM orders
""")
def finished_sections(spark: SparkSession, d: str) -> DataFrame:
    """Written sections with their figures put in, and what the audit says of every other number."""
    k = F.col("o_orderkey")
    value = F.concat((k % 50 + 10).cast("string"), F.lit(" t"))
    template = F.concat(F.lit("Total {{ total }}"), F.when(k % 3 == 0, ", up 77 percent.").when(k % 3 == 1, ", see 2019.").otherwise("."))
    rows = table(spark, d, "orders").select("o_orderkey", template.alias("template"), F.create_map(F.lit("total"), value).alias("figures"), F.array(F.lit("since 2019")).alias("context"))
    return N.finished(rows, T.reference_pattern(["305-1"])).select("o_orderkey", "rendered", "invented", "review", "publishable")
