"""Queries of the domain's compositions: coverage, provenance, summaries, notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions import values as V
from lodestone.functions.fixed import STATUS_ORDER
from lodestone.operators import coverage as C
from lodestone.operators.embedding import targets
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


def star(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """vocabulary, mapping, entities and records over the driver's tables: part brands are disclosures,
    nations entities, and what a nation's suppliers sold of a part are its fields' values."""
    k = F.col("p_partkey")
    p = table(spark, d, "part")
    # some disclosures have no mapping row, and vary in the kinds of those that they have
    mapping = p.where("p_brand not in ('Brand#3', 'Brand#14')").select(
        F.col("p_brand").alias("disclosure"), F.col("p_type").alias("credit"), F.concat(F.lit("part "), k.cast("string")).alias("field"),
        F.when(F.col("p_brand").isin("Brand#5", "Brand#21"), "partial").when((F.col("p_brand") == "Brand#7") & (k % 2 == 0), "gap_gri_side").otherwise(F.element_at(F.array(*map(F.lit, ["equivalent", "component", "intensity", "partial"])), (k % 4 + 1).cast("int"))).alias("relationship"),
        F.when(F.col("p_brand") == "Brand#9", "proposed").when(F.col("p_brand") == "Brand#11", "rejected").when(k % 5 == 0, "rejected").otherwise("confirmed").alias("review_status"),
    )
    vocabulary = p.select(F.concat(F.lit("S"), F.length("p_brand").cast("string")).alias("standard"), F.col("p_brand").alias("disclosure")).distinct()
    entities = table(spark, d, "nation").select(F.col("n_nationkey").alias("entity"))
    sold = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == k)
    value = F.when(F.max("l_discount") > 0.02, F.max("l_quantity").cast("int").cast("string")).otherwise(" ")
    records = sold.groupBy(F.col("s_nationkey").alias("entity"), F.col("p_type").alias("credit"), F.concat(F.lit("part "), k.cast("string")).alias("field")).agg(value.alias("value"))
    return vocabulary, mapping, entities, records


STAR = """
WITH m AS (SELECT p_brand AS disclosure, p_type AS credit, 'part ' || p_partkey AS field, CASE WHEN p_brand IN ('Brand#5', 'Brand#21') THEN 'partial' WHEN p_brand = 'Brand#7' AND p_partkey % 2 = 0 THEN 'gap_gri_side'
    ELSE list_value('equivalent', 'component', 'intensity', 'partial')[p_partkey % 4 + 1] END AS relationship,
    CASE WHEN p_brand = 'Brand#9' THEN 'proposed' WHEN p_brand = 'Brand#11' OR p_partkey % 5 = 0 THEN 'rejected' ELSE 'confirmed' END AS review_status FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#14')),
v AS (SELECT DISTINCT 'S' || length(p_brand) AS standard, p_brand AS disclosure FROM part),
r AS (SELECT s_nationkey AS entity, p_type AS credit, 'part ' || p_partkey AS field, CASE WHEN max(l_discount) > 0.02 THEN max(l_quantity)::INT::VARCHAR ELSE ' ' END AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
u AS (SELECT * FROM m WHERE review_status = 'confirmed' AND relationship IN ('equivalent', 'component', 'intensity', 'partial')),
h AS (SELECT r.entity, u.disclosure, u.relationship, u.credit, u.field, r.value, trim(r.value) <> '' AS populated FROM u JOIN r ON u.credit = r.credit AND u.field = r.field),
c AS (SELECT n_nationkey AS entity, v.standard, v.disclosure,
    (SELECT count(*) FROM m WHERE m.disclosure = v.disclosure AND review_status = 'confirmed') AS confirmed, (SELECT count(*) FROM m WHERE m.disclosure = v.disclosure AND review_status = 'rejected') AS rejected,
    (SELECT count(*) FROM m WHERE m.disclosure = v.disclosure) AS every,
    (SELECT count(*) FROM m WHERE m.disclosure = v.disclosure AND review_status = 'confirmed' AND relationship = 'gap_gri_side') AS gaps,
    (SELECT count(*) FROM u WHERE u.disclosure = v.disclosure AND relationship <> 'partial') AS strong,
    (SELECT count(*) FROM h WHERE h.disclosure = v.disclosure AND h.entity = n_nationkey AND populated) AS vals,
    (SELECT count(*) FROM h WHERE h.disclosure = v.disclosure AND h.entity = n_nationkey AND populated AND relationship <> 'partial') AS strong_vals FROM v, nation),
s AS (SELECT entity, standard, disclosure, CASE WHEN confirmed = 0 AND rejected > 0 THEN 'Not reported' WHEN confirmed = 0 AND every > 0 THEN 'Not reported' WHEN confirmed = 0 THEN 'Not assessed' WHEN gaps > 0 OR vals = 0 THEN 'Not reported' WHEN strong = 0 THEN 'Partially reported' ELSE 'Reported' END AS status,
  CASE WHEN confirmed > 0 AND gaps = 0 THEN vals ELSE 0 END AS values_available, strong > 0 AND confirmed > 0 AND gaps = 0 AND vals > 0 AS citable, strong_vals > 0 AND confirmed > 0 AND gaps = 0 AS citable_strict FROM c)
"""


@query(STAR + "SELECT entity, standard, disclosure, status, values_available, citable, citable_strict FROM s")
def coverage_status(spark: SparkSession, d: str) -> DataFrame:
    """What each entity can report of each disclosure."""
    return C.coverage(*star(spark, d))


@query(STAR + "SELECT entity, disclosure, CASE WHEN confirmed = 0 AND rejected = 0 THEN 'Not assessed' ELSE status END AS status FROM s JOIN c USING (entity, standard, disclosure)")
def index_status(spark: SparkSession, d: str) -> DataFrame:
    """The same as a content index reads it: what is only proposed is not assessed."""
    return C.coverage(*star(spark, d), proposed="Not assessed").select("entity", "disclosure", "status")


@query(STAR + "SELECT disclosure, status, values_available FROM s WHERE entity = 3 AND standard = 'S8'")
def entity_pillar(spark: SparkSession, d: str) -> DataFrame:
    """One entity's disclosures of one standard."""
    return coverage_status(spark, d).where("entity = 3 and standard = 'S8'").select("disclosure", "status", "values_available")


@query(STAR + "SELECT disclosure, count(*) AS entities FROM s WHERE status = 'Partially reported' AND values_available > 0 GROUP BY 1")
def partial_view(spark: SparkSession, d: str) -> DataFrame:
    """Disclosures that entities answer in part, where a caveat has to be shown."""
    return coverage_status(spark, d).where("status = 'Partially reported' and values_available > 0").groupBy("disclosure").agg(F.count(F.lit(1)).alias("entities"))


@query(STAR + "SELECT DISTINCT standard, disclosure FROM v WHERE disclosure NOT IN (SELECT disclosure FROM m) OR disclosure = 'Brand#11'")
def unmapped_targets(spark: SparkSession, d: str) -> DataFrame:
    """The disclosures that candidates are sought for: those without any mapping row, and one that is asked for."""
    vocabulary, mapping, _, _ = star(spark, d)
    return targets(vocabulary, mapping).unionByName(targets(vocabulary, mapping, ["Brand#11"]))


@query(STAR + """, n AS (SELECT entity, status, count(*) AS n FROM s GROUP BY 1, 2)
SELECT entity, status, n, CASE status WHEN 'Reported' THEN 1 WHEN 'Partially reported' THEN 2 WHEN 'Not reported' THEN 3 ELSE 4 END AS place FROM n""")
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    """Disclosures by entity and status, in the statuses' order."""
    n = coverage_status(spark, d).groupBy("entity", "status").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("place", V.position(F.col("status"), STATUS_ORDER).cast("int")).orderBy("entity", "place")


@query(STAR + "SELECT standard, status, count(*) AS n, count(*) FILTER (citable) AS citable FROM s GROUP BY 1, 2")
def coverage_by_standard(spark: SparkSession, d: str) -> DataFrame:
    return coverage_status(spark, d).groupBy("standard", "status").agg(F.count(F.lit(1)).alias("n"), F.count_if("citable").alias("citable"))


@query(STAR + "SELECT entity, count(*) FILTER (status = 'Reported') AS reported, count(*) FILTER (status IN ('Not reported', 'Not assessed')) AS gaps FROM s GROUP BY 1")
def fully_reported(spark: SparkSession, d: str) -> DataFrame:
    return coverage_status(spark, d).groupBy("entity").agg(F.count_if(F.col("status") == "Reported").alias("reported"), F.count_if(F.col("status").isin("Not reported", "Not assessed")).alias("gaps"))


@query(STAR + "SELECT entity, disclosure, relationship, credit, field, value, populated FROM h")
def provenance_rows(spark: SparkSession, d: str) -> DataFrame:
    """The field behind each value of a content index."""
    _, mapping, entities, records = star(spark, d)
    return C.provenance(mapping, entities, records)


@query(STAR + """, t AS (SELECT entity, disclosure, list('**' || field || '**: ' || value ORDER BY field, credit) FILTER (populated) AS a, list(credit || ' / ' || field ORDER BY field, credit) FILTER (NOT populated) AS b FROM h GROUP BY 1, 2)
SELECT entity, disclosure, coalesce(array_to_string(a, '<br>'), '') AS detail, CASE WHEN b IS NULL OR a IS NULL THEN '' ELSE 'Not populated: ' || array_to_string(b[1:3], '; ') || '.' END AS note FROM t""")
def content_index(spark: SparkSession, d: str) -> DataFrame:
    """A disclosure's values and what is missing beside them, as text in a stated order."""
    _, mapping, entities, records = star(spark, d)
    rows = C.provenance(mapping, entities, records)
    shown = F.struct("field", "credit", F.concat(F.lit("**"), F.col("field"), F.lit("**: "), F.col("value")).alias("text"))
    lacking = F.struct("field", "credit", F.concat_ws(" / ", "credit", "field").alias("text"))
    groups = rows.groupBy("entity", "disclosure").agg(F.array_sort(F.collect_list(F.when(F.col("populated"), shown))).alias("a"), F.array_sort(F.collect_list(F.when(~F.col("populated"), lacking))).alias("b"))
    text = lambda c: F.transform(c, lambda s: s["text"])
    note = F.when((F.size("a") == 0) | (F.size("b") == 0), "").otherwise(F.concat(F.lit("Not populated: "), F.array_join(F.slice(text("b"), 1, 3), "; "), F.lit(".")))
    return groups.select("entity", "disclosure", F.array_join(text("a"), "<br>").alias("detail"), note.alias("note"))


RENDERED = "'Order ' || o_orderkey % 1000 || ' of customer ' || o_custkey || ' came to ' || printf('%.2f', o_totalprice) || ' or GRI 305-1 and 3, Scope 2, 3,' || (o_orderkey % 900 + 100) || ' t; twenty or Two.' || CASE WHEN o_orderkey % 7 = 0 THEN ' About 77777 more.' ELSE '' END"


def rendered() -> F.Column:
    k = F.col("o_orderkey")
    return F.concat(
        F.lit("Order "), (k % 1000).cast("string"), F.lit(" of customer "), F.col("o_custkey").cast("string"), F.lit(" came to "), F.format_string("%.2f", "o_totalprice"),
        F.lit(" or GRI 305-1 and 3, Scope 2, 3,"), (k % 900 + 100).cast("string"), F.lit(" t; twenty or Two."), F.when(k % 7 == 0, " About 77777 more.").otherwise(""),
    )


REFERENCES = T.reference_pattern(["305-1", "305", "2-9"])


@query(f"""
WITH t AS (SELECT o_orderkey, [printf('%.2f', o_totalprice)] AS given, [(o_orderkey % 1000)::VARCHAR, o_custkey::VARCHAR] AS near, list_filter(list_transform(regexp_extract_all(replace(replace({RENDERED}, 'GRI 305-1', ' '), 'Scope 2,', ' '), '[0-9][0-9,.]*'), lambda x: regexp_replace(x, '[.,]+$', '')), lambda x: x <> '') AS found FROM orders)
SELECT o_orderkey, array_to_string(list_filter(found, lambda x: list_contains(given, x)), ' ') AS ok, array_to_string(list_sort(list_distinct(list_filter(found, lambda x: list_contains(near, x) AND NOT list_contains(given, x)))), ' ') AS review,
  array_to_string(list_sort(list_distinct(list_filter(found, lambda x: NOT list_contains(near, x) AND NOT list_contains(given, x)))), ' ') AS invented, 'twenty two' AS spelled FROM t
""")
def digit_audit(spark: SparkSession, d: str) -> DataFrame:
    """Where each number of a rendered text comes from; one in seven texts has an invented one."""
    o = table(spark, d, "orders")
    found = T.audit_digits(rendered(), F.array(F.format_string("%.2f", "o_totalprice")), F.array((F.col("o_orderkey") % 1000).cast("string"), F.col("o_custkey").cast("string")), REFERENCES)
    rows = o.select("o_orderkey", found.alias("_audit")).select("o_orderkey", "_audit.*")
    return rows.select("o_orderkey", *[F.array_join(c, " ").alias(c) for c in ("ok", "review", "invented", "spelled")])


@query(f"""
SELECT o_orderkey, replace(replace(regexp_replace(replace(replace({RENDERED}, 'GRI 305-1', '\x01'), 'Scope 2,', '\x02'), '[0-9][0-9,.]*', '[figure]', 'g'), '\x01', 'GRI 305-1'), '\x02', 'Scope 2,') AS text FROM orders
""".replace("\\x01", "\x01"))
def redact_figures(spark: SparkSession, d: str) -> DataFrame:
    """Numbers blanked out, references to a vocabulary and scopes left."""
    return table(spark, d, "orders").select("o_orderkey", T.redact_figures(rendered(), REFERENCES).alias("text"))


@query("""
WITH n AS (SELECT p_partkey, p_name, p_type, 'a long common beginning of every one of these names, ' || p_name || ' ' || p_type AS whole, p_size % 5 AS g FROM part),
s AS (SELECT *, regexp_replace(substr(regexp_replace(regexp_replace(lower(whole), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 60), '_+$', '') AS slug FROM n)
SELECT p_partkey, CASE WHEN min(whole) OVER w <> max(whole) OVER w THEN regexp_replace(substr(slug, 1, 53), '_+$', '') || '_' || substr(sha1(whole), 1, 6) ELSE slug END AS token FROM s WINDOW w AS (PARTITION BY g, slug)
""")
def slug_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Names cut at 60 characters, told apart where they clash."""
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("a long common beginning of every one of these names, "), F.col("p_name")).alias("a"), F.col("p_type").alias("b"), (F.col("p_size") % 5).alias("g"))
    return T.unique_slugs(p, ["g"], ["a", "b"]).select("p_partkey", "token")


@query("""
SELECT o_orderkey, 'Order ' || o_orderkey || ': ' || printf('%.2f', o_totalprice) || ' USD by ' || o_custkey || '.' AS text, 2 AS used FROM orders
""")
def template_render(spark: SparkSession, d: str) -> DataFrame:
    """A strict template: names that have no figure would be an error."""
    o = table(spark, d, "orders")
    figures = F.create_map(F.lit("total"), V.with_unit(F.lit("Total"), F.format_string("%.2f", "o_totalprice"), F.lit("USD")), F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("unused"), F.lit("0"))
    template = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(": {{ total }} by {{customer}}."))
    return o.select("o_orderkey", T.render(template, figures).alias("text"), F.size(T.tokens_in(template)).alias("used"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size || ' kg' WHEN p_size % 3 = 1 THEN p_size || '%' ELSE p_size || ' weeks' END AS text, CASE WHEN p_size % 4 = 0 THEN 'not reported by the institution' WHEN length(repeat(p_name || '|', 5)) > 90 THEN replace(left(repeat(p_name || '|', 5), 87), '|', '\\|') || '…' ELSE replace(repeat(p_name || '|', 5) || ' u', '|', '\\|') END AS cell FROM part
""".replace("\\\\", "\\"))
def value_formats(spark: SparkSession, d: str) -> DataFrame:
    """Values as prose and as table cells show them."""
    size, kind = F.col("p_size"), F.col("p_size") % 3
    label = F.when(kind == 1, "Percentage of rooms").otherwise("Total number of weeks of leave")
    long = F.when(size % 4 == 0, " ").otherwise(F.repeat(F.concat("p_name", F.lit("|")), 5))
    return table(spark, d, "part").select("p_partkey", V.with_unit(label, size.cast("string"), F.when(kind == 0, " kg ")).alias("text"), V.cell(long, F.lit("u")).alias("cell"))


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE l_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN '1,234.5' WHEN 2 THEN '2021' WHEN 3 THEN 'Yes' WHEN 4 THEN 'https://x.org/a' WHEN 5 THEN 'Feb. 3, 2024' WHEN 6 THEN repeat('long ', 41) WHEN 7 THEN ',' ELSE l_returnflag END AS value,
  CASE WHEN l_linenumber = 1 THEN 'Performance Year' ELSE 'Rooms' END AS field, CASE WHEN l_suppkey % 2 = 0 THEN 'kg' ELSE '' END AS units FROM lineitem)
SELECT type, count(*) AS n, round(sum(number), 2) AS total FROM (SELECT CASE WHEN value = '' THEN 'not_reported' WHEN regexp_matches(value, '^-?[0-9,]+(\\.[0-9]+)?$') THEN CASE WHEN field LIKE '%Year' AND units = '' AND value = '2021' THEN 'year' ELSE 'number' END
  WHEN lower(value) = 'yes' THEN 'boolean' WHEN value LIKE 'http%' THEN 'url' WHEN value LIKE 'Feb%' THEN 'date' WHEN length(value) > 200 THEN 'text_long' ELSE 'text' END AS type,
  CASE WHEN regexp_matches(value, '^-?[0-9,]+(\\.[0-9]+)?$') THEN TRY_CAST(replace(value, ',', '') AS DOUBLE) END AS number FROM v) GROUP BY type
""")
def value_typing(spark: SparkSession, d: str) -> DataFrame:
    """Answers by type, and the sum of the numeric ones."""
    k = F.col("l_partkey") % 9
    kinds = ["", "1,234.5", "2021", "Yes", "https://x.org/a", "Feb. 3, 2024", "long " * 41, ","]
    value = F.when(k < 8, F.element_at(F.array(*map(F.lit, kinds)), (F.least(k, F.lit(7)) + 1).cast("int"))).otherwise(F.col("l_returnflag"))
    rows = table(spark, d, "lineitem").select(value.alias("value"), F.when(F.col("l_linenumber") == 1, "Performance Year").otherwise("Rooms").alias("field"), F.when(F.col("l_suppkey") % 2 == 0, "kg").otherwise("").alias("units"))
    typed = rows.select(V.value_type(F.col("field"), F.col("value"), F.col("units")).alias("type"), V.value_numeric(F.col("value")).alias("number"))
    return typed.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("number"), 2).alias("total"))
