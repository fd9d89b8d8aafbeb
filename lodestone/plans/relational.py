"""Relational queries: unions, joins with origin, anchors, merges, integrity, grouped ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import values as V
from lodestone.functions.nulls import is_populated
from lodestone.operators import joins as J
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


@query("""
SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, '', 'supplier' FROM supplier
""")
def union_parties(spark: SparkSession, d: str) -> DataFrame:
    """Like-shaped frames in one, a constant column for their kind, what one lacks filled."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return J.pick(J.uniform([c, s]), ["party_id", "name", "nation", "balance", "segment", "kind", "absent"])


@query("""
WITH c AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'PRE' WHEN 1 THEN 'AC' WHEN 2 THEN 'EN' WHEN 3 THEN 'OP' WHEN 4 THEN 'PA' ELSE 'XX' END || '-' || regexp_extract(p_brand, '#([0-9]+)', 1) AS code FROM part)
SELECT p_partkey, code, CASE WHEN code LIKE 'PRE-%' THEN 'Preface' WHEN code LIKE 'AC-%' OR code LIKE 'EN-%' THEN 'Context' WHEN code LIKE 'OP-%' THEN 'Environmental'
  WHEN code LIKE 'PA-%' AND split_part(code, '-', 2)::INT <= 5 THEN 'Governance' WHEN code LIKE 'PA-%' THEN 'Social' WHEN code LIKE 'IL-%' THEN 'Bonus' ELSE 'Unknown' END AS pillar FROM c
""")
def classify_codes(spark: SparkSession, d: str) -> DataFrame:
    """A category from a code's letters and, for one of them, its number."""
    p = table(spark, d, "part")
    letters = F.element_at(F.array(*map(F.lit, ["PRE", "AC", "EN", "OP", "PA", "XX"])), (F.col("p_partkey") % 6 + 1).cast("int"))
    p = p.select("p_partkey", F.concat_ws("-", letters, F.regexp_extract("p_brand", "#([0-9]+)", 1)).alias("code"))
    return p.withColumn("pillar", V.pillar(F.col("code")))


@query("""
SELECT c_mktsegment, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p, count(*) FILTER (o_orderstatus = 'X') AS x
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def pivot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a category by another, zeros filled, of stated values."""
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    out = rows.groupBy("c_mktsegment").pivot("o_orderstatus", ["F", "O", "P", "X"]).agg(F.count(F.lit(1))).fillna(0)
    return out.select("c_mktsegment", *[F.col(c).cast("long").alias(c.lower()) for c in "FOPX"])


@query("""
SELECT coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE event_type END, '(none)') AS value, count(*) AS n FROM events GROUP BY 1
""")
def value_counts_null(spark: SparkSession, d: str) -> DataFrame:
    """How often each value occurs, missing ones under a label of their own."""
    e = table(spark, d, "events").select(F.when(F.col("event_type") != "error", F.col("event_type")).alias("value"))
    return e.groupBy(F.coalesce("value", F.lit("(none)")).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def master(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    # lines of orders that aren't there, so that the check for orphans has something to find
    li = li.unionByName(li.where("l_partkey % 500 = 1 and l_linenumber = 1").withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return J.outer_with_origin(o, li, ["o_orderkey"], [F.col("l_linenumber").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]])


LINES = """
WITH li AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
  UNION ALL SELECT -l_orderkey - 1, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem WHERE l_partkey % 500 = 1 AND l_linenumber = 1
), m AS (
  SELECT coalesce(o_orderkey, l_orderkey) AS k, o_totalprice, l_linenumber, l_partkey, l_extendedprice, o_orderkey IS NOT NULL AS has_left, l_orderkey IS NOT NULL AS has_detail,
    o_orderkey IS NOT NULL AND row_number() OVER (PARTITION BY coalesce(o_orderkey, l_orderkey) ORDER BY l_linenumber NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST) = 1 AS anchor
  FROM orders FULL OUTER JOIN li ON o_orderkey = l_orderkey
)
"""


@query(LINES + "SELECT k AS o_orderkey, l_linenumber, l_partkey, has_left, has_detail, anchor FROM m")
def master_outer_join(spark: SparkSession, d: str) -> DataFrame:
    """Totals beside details: each key's first row is the anchor that carries the total."""
    return master(spark, d).select("o_orderkey", "l_linenumber", "l_partkey", "has_left", "has_detail", "anchor")


@query(LINES + """
SELECT round(sum(CASE WHEN has_left THEN o_totalprice::DECIMAL(18, 2) END)::DOUBLE, 2) AS naive, round(sum(CASE WHEN anchor THEN o_totalprice::DECIMAL(18, 2) END)::DOUBLE, 2) AS anchored,
  round(sum(CASE WHEN has_left THEN o_totalprice::DECIMAL(18, 2) END)::DOUBLE / sum(CASE WHEN anchor THEN o_totalprice::DECIMAL(18, 2) END)::DOUBLE, 6) AS overcount FROM m
""")
def anchored_vs_naive(spark: SparkSession, d: str) -> DataFrame:
    """The sum over anchors and over all rows, which counts each total once for each of its details."""
    m, price = master(spark, d), F.col("o_totalprice").cast("decimal(18,2)")
    sums = m.agg(F.sum(F.when(F.col("has_left"), price)).cast("double").alias("naive"), F.sum(F.when(F.col("anchor"), price)).cast("double").alias("anchored"))
    return sums.select(F.round("naive", 2).alias("naive"), F.round("anchored", 2).alias("anchored"), F.round(F.col("naive") / F.col("anchored"), 6).alias("overcount"))


@query(LINES + """
SELECT 'orphans' AS counter, count(*) FILTER (NOT has_left) AS n FROM m UNION ALL SELECT 'without_detail', count(*) FILTER (NOT has_detail) FROM m
UNION ALL SELECT 'rows', count(*) FROM m UNION ALL SELECT 'anchors', count(*) FILTER (anchor) FROM m UNION ALL SELECT 'parents', (SELECT count(*) FROM orders)
UNION ALL SELECT 'details', (SELECT count(*) FROM li)
""")
def reconciliation_checks(spark: SparkSession, d: str) -> DataFrame:
    """The counters by which a join of totals and details is reconciled."""
    m = master(spark, d)
    n = m.agg(F.count_if(~F.col("has_left")).alias("orphans"), F.count_if(~F.col("has_detail")).alias("without_detail"), F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"), F.count_if(F.col("anchor")).alias("parents"), F.count_if("has_detail").alias("details"))
    parents = table(spark, d, "orders").agg(F.count(F.lit(1)).alias("parents"))
    n = n.drop("parents").join(F.broadcast(parents))
    return n.unpivot([], ["orphans", "without_detail", "rows", "anchors", "parents", "details"], "counter", "n")


@query("""
SELECT 'repeated keys' AS counter, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem
UNION ALL SELECT 'discount above 0.05', count(*) FROM lineitem WHERE l_discount > 0.05 UNION ALL SELECT 'no total', count(*) FROM orders WHERE o_totalprice IS NULL
UNION ALL SELECT 'not scored', count(*) FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id
""")
def validation_counters(spark: SparkSession, d: str) -> DataFrame:
    """Repeated keys, impossible values, missing values, and rows without a counterpart."""
    li, o, docs, labels = (table(spark, d, t) for t in ("lineitem", "orders", "documents", "labels"))
    repeated = li.groupBy("l_orderkey", "l_linenumber").agg((F.count(F.lit(1)) - 1).alias("_more")).agg(F.sum("_more").alias("n"))
    one = lambda name, rows: rows.select(F.lit(name).alias("counter"), "n")
    count = lambda rows: rows.agg(F.count(F.lit(1)).alias("n"))
    return (
        one("repeated keys", repeated)
        .unionByName(one("discount above 0.05", count(li.where("l_discount > 0.05D"))))
        .unionByName(one("no total", count(o.where("o_totalprice is null"))))
        .unionByName(one("not scored", count(docs.join(labels, "doc_id", "left_anti"))))
    )


@query("""
SELECT p_partkey, sum(l_quantity) AS quantity, CASE WHEN p_size % 10 = 0 THEN NULL ELSE round_even(100 * sum(l_quantity) / (p_size % 10 * 500), 1) END AS pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey, p_size
""")
def pct_of_max(spark: SparkSession, d: str) -> DataFrame:
    """A percentage of a maximum, half-even, null where the maximum is 0."""
    sums = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 10 * 500).alias("most"))
    return sums.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "quantity", V.percentage(F.col("quantity"), F.col("most").cast("double")).alias("pct"))


@query("""
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 4 END, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS nth FROM lineitem) WHERE nth = 1
""")
def strongest_link(spark: SparkSession, d: str) -> DataFrame:
    """Of each key's links the strongest by a ranking of kinds, ties by a total order."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    order = [V.position(F.col("l_returnflag"), ["R", "A", "N"]), "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return J.keep(li, ["l_partkey"], order).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@query("""
SELECT user_id, arg_min(event_id, event_id) AS first_event, arg_max(event_id, event_id) AS last_event, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type FROM events GROUP BY user_id
""")
def dedupe_first_last(spark: SparkSession, d: str) -> DataFrame:
    """A key's first and last rows by an ordinal, in one aggregation."""
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"))


REGIONS = "SELECT l_partkey, n_regionkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"


@query(f"SELECT p_partkey, p_name, coalesce(n, 0) = 5 AS comparable FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT n_regionkey) AS n FROM ({REGIONS}) GROUP BY l_partkey) ON l_partkey = p_partkey")
def comparable_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Whether a metric is there for all members of a group."""
    places = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    sold = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    known = sold.groupBy("p_partkey").agg((F.countDistinct("n_regionkey") == 5).alias("comparable"))
    return table(spark, d, "part").select("p_partkey", "p_name").join(known, "p_partkey", "left").withColumn("comparable", F.coalesce("comparable", F.lit(False)))


@query(f"""
SELECT p_partkey, p_name FROM part JOIN (SELECT l_partkey, count(DISTINCT n_regionkey) AS n FROM ({REGIONS}) GROUP BY l_partkey) ON l_partkey = p_partkey WHERE n = 5 AND regexp_matches(p_name, '(?i)RED|blue r') AND p_type LIKE '%STAND%'
""")
def intensity_filter(spark: SparkSession, d: str) -> DataFrame:
    """What may be compared: a pattern in the name, all members there, and a basis that matches."""
    rows = comparable_metrics(spark, d).where("comparable").join(table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey")
    return rows.where(F.col("p_name").rlike("(?i)RED|blue r") & F.contains("p_type", F.lit("STAND"))).select("p_partkey", "p_name")


@query("""
SELECT o_orderpriority, count(*) AS rows, count(v) AS scored, round(count(v) / count(*), 6) AS share, round(sum(v)::DOUBLE / nullif(sum(w), 0)::DOUBLE, 6) AS ratio
FROM (SELECT o_orderpriority, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice::DECIMAL(18, 2) END AS v, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 500000.00::DECIMAL(18, 2) END AS w FROM orders) GROUP BY o_orderpriority
""")
def group_ratio(spark: SparkSession, d: str) -> DataFrame:
    """The share of scored rows, and the ratio of two sums, of each group."""
    scored = F.col("o_orderkey") % 7 != 0
    o = table(spark, d, "orders").select("o_orderpriority", F.when(scored, F.col("o_totalprice").cast("decimal(18,2)")).alias("v"), F.when(scored, F.lit("500000.00").cast("decimal(18,2)")).alias("w"))
    sums = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("scored"), F.sum("v").cast("double").alias("_v"), F.sum("w").cast("double").alias("_w"))
    return sums.select("o_orderpriority", "rows", "scored", F.round(F.col("scored") / F.col("rows"), 6).alias("share"), F.round(F.col("_v") / F.nullif(F.col("_w"), F.lit(0.0)), 6).alias("ratio"))


@query("""
SELECT user_id, min(event_id) FILTER (value > 50) AS first_id, arg_min(event_type, event_id) FILTER (value > 50) AS first_type, count(DISTINCT event_type) AS types FROM events GROUP BY user_id
""")
def first_populated(spark: SparkSession, d: str) -> DataFrame:
    """A key's first row that holds something, and how many kinds of rows it has."""
    e = table(spark, d, "events").withColumn("_at", F.when(F.col("value") > 50, F.col("event_id")))
    return e.groupBy("user_id").agg(F.min("_at").alias("first_id"), F.min_by("event_type", "_at").alias("first_type"), F.countDistinct("event_type").alias("types"))


@query("""
SELECT lang, count(*) AS docs, min(n_chars) AS least, list_sort(list(n_chars))[len(list(n_chars)) // 2 + 1] AS upper_median, max(n_chars) AS most, sum(n_chars)::BIGINT AS total FROM documents GROUP BY lang
""")
def upper_median_stats(spark: SparkSession, d: str) -> DataFrame:
    """Least, upper median, most and total of each group.

    The median is found by counts of equal values, not by collecting a group's rows in one.
    """
    docs = table(spark, d, "documents").where("n_chars is not null")
    counts = docs.groupBy("lang", "n_chars").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang").orderBy("n_chars")
    placed = counts.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(Window.partitionBy("lang")))
    middle = F.floor(F.col("_all") / 2) + 1
    at = F.when((F.col("_upto") >= middle) & (F.col("_upto") - F.col("n") < middle), F.col("n_chars"))
    return placed.groupBy("lang").agg(F.sum("n").alias("docs"), F.min("n_chars").alias("least"), F.max(at).alias("upper_median"), F.max("n_chars").alias("most"), F.sum(F.col("n") * F.col("n_chars")).alias("total"))


@query("""
SELECT 'order without customer' AS rule, o_orderkey AS key FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 3 THEN -1 ELSE o_custkey END AS c FROM orders) o ANTI JOIN customer ON c = c_custkey
UNION ALL SELECT 'line without part', l_orderkey FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 2000 = 5 THEN 0 - l_partkey - 1 ELSE l_partkey END AS p FROM lineitem) l ANTI JOIN part ON p = p_partkey
UNION ALL SELECT 'wrong region', n_nationkey FROM nation WHERE n_regionkey <> n_nationkey % 5
""")
def fk_integrity(spark: SparkSession, d: str) -> DataFrame:
    """A row for each reference that leads nowhere, or to the wrong parent; some are planted."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 1000 == 3, -1).otherwise(F.col("o_custkey")).alias("c"))
    li = table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_orderkey") % 2000 == 5, -F.col("l_partkey") - 1).otherwise(F.col("l_partkey")).alias("p"))
    n = table(spark, d, "nation")
    of = lambda rule, rows, key: rows.select(F.lit(rule).alias("rule"), F.col(key).cast("long").alias("key"))
    return (
        of("order without customer", J.orphans(o, table(spark, d, "customer"), "c", "c_custkey"), "o_orderkey")
        .unionByName(of("line without part", J.orphans(li, table(spark, d, "part"), "p", "p_partkey"), "l_orderkey"))
        .unionByName(of("wrong region", n.where(F.col("n_regionkey") != F.col("n_nationkey") % 5), "n_nationkey"))
    )


@query("""
WITH l AS (SELECT doc_id FROM labels UNION ALL SELECT -doc_id - 1 FROM labels WHERE doc_id % 50 = 0)
SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM l) UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM l EXCEPT SELECT doc_id FROM documents)
""")
def vocabulary_diff(spark: SparkSession, d: str) -> DataFrame:
    """What only one of two vocabularies has; some dangling keys are planted."""
    labels = table(spark, d, "labels").select("doc_id")
    planted = labels.where("doc_id % 50 = 0").select((-F.col("doc_id") - 1).alias("doc_id"))
    return J.two_way_difference(table(spark, d, "documents").select("doc_id"), labels.unionByName(planted), "doc_id")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber <= 4 EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 25
""")
def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    """What is left of a multiset when another is taken from it, repeats counted."""
    li = table(spark, d, "lineitem")
    return li.where("l_linenumber <= 4").select("l_orderkey", "l_linenumber").exceptAll(li.where("l_quantity < 25").select("l_orderkey", "l_linenumber"))


@query("""
SELECT source, count(*) AS docs, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS labelled, round(count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) / count(*), 6) AS share FROM documents GROUP BY source
""")
def numeric_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The share of rows that have a counterpart, by group."""
    labels = table(spark, d, "labels").select("doc_id").distinct().withColumn("_there", F.lit(1))
    rows = table(spark, d, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.count("_there").alias("labelled")).withColumn("share", F.round(F.col("labelled") / F.col("docs"), 6))


@query("""
WITH b AS (SELECT user_id, 0 AS side, event_id, event_type, value FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT user_id, 1, event_id, event_type, value FROM events WHERE event_id % 3 = 0 AND user_id % 2 = 0)
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY side DESC, event_id DESC) AS nth FROM b) WHERE nth = 1
""")
def upsert_keep_last(spark: SparkSession, d: str) -> DataFrame:
    """A batch over a base: by key the batch's last row, else the base's."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return J.upsert(e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0 and user_id % 2 = 0"), ["user_id"], [F.desc("event_id")])


@query("""
WITH b AS (SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 10 <> 9), c AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Brand#99' END AS p_brand, CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE p_size + 1 END AS p_size FROM part WHERE p_partkey % 7 = 0),
i AS (SELECT p_partkey, p_brand, 0 AS p_size FROM part WHERE p_partkey % 5 = 4)
SELECT coalesce(b.p_partkey, c.p_partkey) AS p_partkey, coalesce(c.p_brand, b.p_brand) AS p_brand, coalesce(c.p_size, b.p_size) AS p_size,
  CASE WHEN b.p_partkey IS NULL THEN 'missing' WHEN c.p_partkey IS NULL THEN 'kept' WHEN (c.p_brand IS NOT NULL AND c.p_brand <> b.p_brand) OR c.p_size <> b.p_size THEN 'applied' ELSE 'already' END AS outcome
FROM b FULL OUTER JOIN c ON b.p_partkey = c.p_partkey
UNION ALL SELECT p_partkey, p_brand, p_size, 'inserted' FROM i ANTI JOIN b ON i.p_partkey = b.p_partkey
""")
def amend_and_insert(spark: SparkSession, d: str) -> DataFrame:
    """Changes to rows that are there, and rows that aren't there yet, with what became of each."""
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    changes = p.where("p_partkey % 7 = 0").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, "Brand#99").alias("p_brand"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_size")).otherwise(F.col("p_size") + 1).alias("p_size"))
    inserts = p.where("p_partkey % 5 = 4").withColumn("p_size", F.lit(0))
    return J.amend(p.where("p_partkey % 10 <> 9"), changes, inserts, ["p_partkey"])


@query("""
SELECT p_partkey AS id, regexp_extract(p_brand, '#([0-9]+)', 1) || CASE WHEN p_size % 11 = 0 THEN 'x' ELSE '-' || p_size END AS number, row_number() OVER (ORDER BY CASE WHEN p_size % 11 = 0 THEN 9999 ELSE regexp_extract(p_brand, '#([0-9]+)', 1)::INT END, CASE WHEN p_size % 11 = 0 THEN 0 ELSE p_size END, p_partkey) AS place
FROM part QUALIFY place <= 100
""")
def composite_sort_topn(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred by a compound number, "2-9" before "2-10", malformed ones last."""
    p = table(spark, d, "part")
    number = F.concat(F.regexp_extract("p_brand", "#([0-9]+)", 1), F.when(F.col("p_size") % 11 == 0, "x").otherwise(F.concat(F.lit("-"), F.col("p_size"))))
    p = p.select(F.col("p_partkey").alias("id"), number.alias("number"))
    top = p.orderBy(*V.compound_key(F.col("number")), "id").limit(100)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*V.compound_key(F.col("number")), "id")))


@query("""
SELECT status, n, row_number() OVER (ORDER BY nth) AS place FROM (SELECT o_orderstatus AS status, count(*) AS n, CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS nth FROM orders GROUP BY 1, 3)
""")
def ordered_categories(spark: SparkSession, d: str) -> DataFrame:
    """Counts by category in a stated order."""
    n = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(V.position(F.col("status"), ["P", "O", "F"])))).select("status", "n", "place")


@query("""
SELECT o_custkey, bool_or(o_orderstatus = 'P') AS any_p, bool_and(o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')) AS only_some, count(*) FILTER (o_totalprice > 100000) AS populated,
  array_to_string(list_slice(list(o_orderkey::VARCHAR ORDER BY o_orderkey), 1, 3), '; ') AS first_three FROM orders GROUP BY o_custkey
""")
def group_flags(spark: SparkSession, d: str) -> DataFrame:
    """Any and all over a group, a count of what holds, and its first three members in order."""
    o = table(spark, d, "orders")
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    first = F.array_sort(F.collect_list(F.when(F.col("nth") <= 3, F.col("o_orderkey"))))  # three at most
    return o.withColumn("nth", nth).groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "P").alias("any_p"), F.bool_and(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")).alias("only_some"),
        F.count_if(F.col("o_totalprice") > 100000).alias("populated"), F.array_join(F.transform(first, lambda k: k.cast("string")), "; ").alias("first_three"),
    )


@query("""
SELECT n_name, array_to_string(list_distinct_ordered, '; ') AS names FROM (SELECT n_name, list(s_name ORDER BY s_suppkey) AS list_distinct_ordered FROM nation JOIN supplier ON n_nationkey = s_nationkey WHERE s_acctbal IS NOT NULL GROUP BY n_name)
""")
def ordered_string_agg(spark: SparkSession, d: str) -> DataFrame:
    """A group's names as one string, in a stated order."""
    rows = table(spark, d, "supplier").where(is_populated("s_name")).join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    names = F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name")))
    return rows.groupBy("n_name").agg(F.array_join(F.transform(names, lambda s: s["s_name"]), "; ").alias("names"))


@query("""
WITH m AS (SELECT p_partkey AS line, 'C-' || p_partkey % 40 AS credit, CASE WHEN p_partkey % 9 = 0 THEN '*' ELSE 'f' || p_partkey % 13 END AS field, 'S' || p_partkey % 4 AS standard, CASE WHEN p_partkey % 17 = 0 THEN ' ' ELSE p_partkey % 4 || '-' || p_partkey % 8 END AS disclosure,
  list_value('equivalent', 'component', 'intensity', 'partial', 'gap_gri_side', 'gap_stars_side', 'odd')[p_partkey % 7 + 1] AS relationship, list_value('proposed', 'confirmed', 'rejected', 'done')[p_partkey % 4 + 1] AS review_status, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'c' END AS caveat FROM part),
v AS (SELECT 'S' || p_partkey % 4 AS s, p_partkey % 4 || '-' || p_partkey % 7 AS d FROM part WHERE p_partkey % 7 <> 6 GROUP BY 1, 2), r AS (SELECT 'C-' || p_partkey % 36 AS c, 'f' || p_partkey % 12 AS f FROM part GROUP BY 1, 2),
wd AS (SELECT * FROM m WHERE relationship <> 'gap_stars_side'), wc AS (SELECT * FROM m WHERE relationship <> 'gap_gri_side')
SELECT line, 'unknown relationship' AS rule FROM m WHERE relationship = 'odd' UNION ALL SELECT line, 'unknown review status' FROM m WHERE review_status = 'done'
UNION ALL SELECT line, 'disclosure not allowed' FROM m WHERE relationship = 'gap_stars_side' AND trim(disclosure) <> '' UNION ALL SELECT line, 'disclosure missing' FROM wd WHERE trim(disclosure) = ''
UNION ALL SELECT line, 'disclosure unknown' FROM wd WHERE trim(disclosure) <> '' AND disclosure NOT IN (SELECT d FROM v) UNION ALL SELECT line, 'wrong standard' FROM wd JOIN v ON disclosure = d WHERE standard <> s
UNION ALL SELECT line, 'credit not allowed' FROM m WHERE relationship = 'gap_gri_side' UNION ALL SELECT line, 'credit unknown' FROM wc WHERE credit NOT IN (SELECT c FROM r)
UNION ALL SELECT line, 'field unknown' FROM wc WHERE credit IN (SELECT c FROM r) AND field <> '*' AND (credit, field) NOT IN (SELECT (c, f) FROM r) UNION ALL SELECT line, 'warning: partial without caveat' FROM m WHERE relationship = 'partial' AND caveat = ''
""")
def mapping_violations(spark: SparkSession, d: str) -> DataFrame:
    """A row for each rule that a row of a crosswalk breaks."""
    p, k = table(spark, d, "part"), F.col("p_partkey")
    text = lambda c: c.cast("string")
    one = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (k % n + 1).cast("int"))
    mapping = p.select(
        k.alias("line"), F.concat(F.lit("C-"), text(k % 40)).alias("credit"), F.when(k % 9 == 0, "*").otherwise(F.concat(F.lit("f"), text(k % 13))).alias("field"), F.concat(F.lit("S"), text(k % 4)).alias("standard"),
        F.when(k % 17 == 0, " ").otherwise(F.concat_ws("-", text(k % 4), text(k % 8))).alias("disclosure"), one(7, "equivalent", "component", "intensity", "partial", "gap_gri_side", "gap_stars_side", "odd").alias("relationship"),
        one(4, "proposed", "confirmed", "rejected", "done").alias("review_status"), F.when(k % 3 == 0, "").otherwise("c").alias("caveat"),
    )
    vocabulary = p.where(k % 7 != 6).select(F.concat(F.lit("S"), text(k % 4)).alias("standard"), F.concat_ws("-", text(k % 4), text(k % 7)).alias("disclosure")).distinct()
    records = p.select(F.concat(F.lit("C-"), text(k % 36)).alias("credit"), F.concat(F.lit("f"), text(k % 12)).alias("field")).distinct()
    from lodestone.functions.fixed import RELATIONSHIPS, REVIEW_STATES

    return J.violations(mapping, vocabulary, records, RELATIONSHIPS, REVIEW_STATES)
