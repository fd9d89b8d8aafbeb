"""Queries over documents, vectors and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.stages import written
from lodestone.functions import fixed as X
from lodestone.functions import text as T
from lodestone.operators import chunking as K
from lodestone.operators import html as H
from lodestone.operators import vectors as W
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


def counted(terms: list[str], text: str = "low") -> str:
    return " + ".join(f"(length({text}) - length(replace({text}, '{t}', ''))) // {len(t)}" for t in terms)


#: Some documents with each mark, since the data have none.
MARKED_SQL = """text || CASE doc_id % 9 WHEN 0 THEN repeat(' emission carbon disclosure', n_chars::INT // 60 + 1) WHEN 1 THEN ' Please enable JavaScript' WHEN 2 THEN ' pricing pricing enroll certificate start free' WHEN 3 THEN ' {{ name }}' || chr(10) || '  ' || chr(10) || chr(10) || 'end  ' ELSE '' END"""


def marked(docs: DataFrame) -> DataFrame:
    k = F.col("doc_id") % 9
    more = (
        F.when(k == 0, F.repeat(F.lit(" emission carbon disclosure"), (F.floor(F.col("n_chars") / 60) + 1).cast("int"))).when(k == 1, " Please enable JavaScript")
        .when(k == 2, " pricing pricing enroll certificate start free").when(k == 3, " {{ name }}\n  \n\nend  ").otherwise("")
    )
    return docs.withColumn("text", F.concat("text", more))


@query(f"""
WITH d AS (SELECT doc_id, {MARKED_SQL} AS text FROM documents), l AS (SELECT doc_id, text, lower(text) AS low, greatest(len(regexp_extract_all(text, '[^\\s]+')), 1) AS words FROM d),
f AS (SELECT *, ({counted(X.TOPIC_TERMS)}) / words * 1000 AS per, (contains(low, '{"') OR contains(low, '".join(X.CONSENT_MARKERS)}')) AS consent, contains(text, '{{{{') AS junk FROM l)
SELECT doc_id, array_to_string(list_filter([CASE WHEN consent THEN 'CONSENT-WALL' END, CASE WHEN {counted(X.FRENCH_MARKERS)} > 25 THEN 'FRENCH' END, CASE WHEN per < 25 THEN 'LOW-ESG(' || round_even(per, 0)::INT || '/1k)' END,
  CASE WHEN {counted(X.SALES_TERMS)} >= 5 THEN 'SALES-PAGE' END, CASE WHEN junk THEN 'TEMPLATE-JUNK' END, CASE WHEN words < 200 THEN 'THIN' END], lambda x: x IS NOT NULL), ' ') AS flags,
  CASE WHEN length(text) >= 500 AND NOT consent AND NOT junk THEN 'ok' ELSE 'CHECK' END AS status FROM f
""")
def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    """A page's warnings and whether it may be used."""
    docs = marked(table(spark, d, "documents")).withColumn("flags", T.quality_flags(F.col("text")))
    return docs.select("doc_id", F.array_join("flags", " ").alias("flags"), T.source_status(F.col("text"), F.col("flags")).alias("status"))


@query(f"""
SELECT doc_id, sha1(regexp_replace(array_to_string(list_filter(list_transform(string_split(regexp_replace({MARKED_SQL}, '\\{{\\{{[^}}]*\\}}\\}}', '', 'g'), chr(10)), lambda x: regexp_replace(x, '\\s+$', '')), lambda x: x <> ''), chr(10)), '^\\s+', '')) AS sha FROM documents
""")
def scrub_text(spark: SparkSession, d: str) -> DataFrame:
    """Text without template code and blank lines."""
    return marked(table(spark, d, "documents")).select("doc_id", F.sha1(T.scrub(F.col("text"))).alias("sha"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 31 = 0 THEN 'spreadsheet' WHEN length(text) > 200000 THEN 'oversized' WHEN row_number() OVER (PARTITION BY doc_id % 31 = 0, length(text) > 200000, sha1(text) ORDER BY doc_id) > 1 THEN 'duplicate' END AS skipped FROM documents
""")
def content_hash_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Which documents are indexed, and why others aren't."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 31 == 0, ".xlsx").otherwise(".pdf").alias("extension"))
    return K.indexable(docs).select("doc_id", "skipped")


CHUNKS = """
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS paras FROM documents WHERE len(regexp_extract_all(text, '[^\\s]+')) >= 100),
t AS (SELECT doc_id, flatten(list_transform(paras, lambda q: CASE WHEN length(q) > 1000 THEN list_concat([{'kind': 'f', 'x': ''}], list_transform(string_split(regexp_replace(q, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {'kind': 's', 'x': s}), [{'kind': 'f', 'x': ''}])
  ELSE [{'kind': 'p', 'x': q}] END)) AS steps FROM p),
r AS (SELECT doc_id, list_reduce(list_transform(list_concat(steps, [{'kind': 'f', 'x': ''}]), lambda s: {'kind': s.kind, 'x': s.x, 'done': []::VARCHAR[], 'cur': ''}), lambda a, b:
  {'kind': '', 'x': '', 'done': CASE WHEN (b.kind = 'f' OR (length(a.cur) + length(b.x) + 1 > 1000 AND a.cur <> '')) AND length(a.cur) >= 120 THEN list_append(a.done, a.cur) ELSE a.done END,
   'cur': CASE WHEN b.kind = 'f' THEN '' WHEN length(a.cur) + length(b.x) + 1 > 1000 AND a.cur <> '' THEN CASE WHEN b.kind = 's' THEN b.x ELSE regexp_replace(regexp_replace(right(a.cur, 200), '^\\s+|\\s+$', '', 'g') || chr(10) || b.x, '^\\s+|\\s+$', '', 'g') END
     ELSE regexp_replace(a.cur || CASE WHEN b.kind = 's' THEN ' ' ELSE chr(10) END || b.x, '^\\s+|\\s+$', '', 'g') END}, {'kind': '', 'x': '', 'done': []::VARCHAR[], 'cur': ''}) AS s FROM t),
c AS (SELECT doc_id, generate_subscripts(s.done, 1) - 1 AS chunk_index, unnest(s.done) AS chunk FROM r)
"""


@query(CHUNKS + "SELECT doc_id, chunk_index::INT AS chunk_index, sha1(chunk) AS sha, length(chunk) AS chars, len(regexp_extract_all(chunk, '[^\\s]+')) AS words FROM c")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents in overlapping chunks of about a thousand characters."""
    return K.chunk_records(table(spark, d, "documents")).select("doc_id", "chunk_index", F.sha1("chunk").alias("sha"), "chars", "words")


CLAIMS = "CASE WHEN chunk_index % 3 = 0 THEN ' about 26,000 tons' WHEN chunk_index % 3 = 1 THEN ' in 2024 15% of it' ELSE '' END"


@query(CHUNKS + f"SELECT doc_id, count(*) AS chunks, count(*) FILTER (regexp_matches(chunk || {CLAIMS}, '(?i)\\b[0-9][0-9,.]*\\s*(?:(?:percent|tonnes?|tons?|kWh|MWh|GWh|million|billion|USD|EUR)\\b|%|\\$|€)')) AS claims, count(*) FILTER (regexp_matches(chunk || {CLAIMS}, '(?i)\\b[0-9][0-9,.]*\\s*(?:percent|tonnes?|tons?|kWh|MWh|GWh|million|billion|USD|EUR|%|\\$|€)\\b')) AS strict FROM c GROUP BY doc_id")
def chunk_quantities(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that claim a quantity, by either reading of a percent sign; some are planted."""
    k = F.col("chunk_index") % 3
    text = F.concat("chunk", F.when(k == 0, " about 26,000 tons").when(k == 1, " in 2024 15% of it").otherwise(""))
    rows = K.chunk_records(table(spark, d, "documents")).withColumn("text", text)
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.count_if(T.has_quantity(F.col("text"))).alias("claims"), F.count_if(T.has_quantity(F.col("text"), parity=True)).alias("strict"))


@query("""
SELECT doc_id, sha1(array_to_string(list_transform(list_filter(list_transform(list_distinct(list_transform(x, lambda v: v)), lambda v: {'at': list_position(x, v), 'v': v}), lambda s: s.v <> '').list_sort(), lambda s: s.v), ' ')) AS sha FROM (
  SELECT doc_id, list_transform(string_split(regexp_replace(trim(text) || ' ' || trim(text), '(\\.)\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda v: trim(v)) AS x FROM documents)
""")
def sentence_merge(spark: SparkSession, d: str) -> DataFrame:
    """Texts joined with each sentence once, in order."""
    t = F.trim(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.sha1(T.merge_sentences(F.array(F.concat_ws(" ", t, t)))).alias("sha"))


STOP = "', '".join(X.STOPWORDS)
TERMS = f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9-]+')) AS term FROM documents), c AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term NOT IN ('{STOP}') GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df, ln((1.0e0 + (SELECT count(*) FROM documents)) / (1.0e0 + count(*))) + 1 AS idf FROM c GROUP BY term HAVING count(*) >= 2),
r AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM c JOIN f USING (term)), w AS (SELECT doc_id, term, w / greatest(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 1e-12) AS w FROM r)
"""


def lexical(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The counts of each document's terms, and the weights of terms, written; counts, many times their size, are made again from texts instead."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    counts = W.term_counts(docs, "doc_id", "text")
    return counts, written(W.document_frequencies(counts, docs.count()))


@query(TERMS + "SELECT term, df, round(idf, 6) AS idf FROM f")
def term_df(spark: SparkSession, d: str) -> DataFrame:
    """Terms of two or more documents, with their weight in the corpus."""
    return lexical(spark, d)[1].withColumn("idf", F.round("idf", 6))


@query(TERMS + "SELECT doc_id, term, round(w, 6) AS w FROM w")
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    """Each document's terms, weighted, with length 1."""
    counts, frequencies = lexical(spark, d)
    return W.weights(counts, frequencies, "doc_id").withColumn("w", F.round("w", 6))


@query(TERMS + f""", qc AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z0-9-]+')) AS term FROM benchmark) WHERE term NOT IN ('{STOP}') GROUP BY 1, 2),
qr AS (SELECT item_id, term, (1 + ln(tf)) * idf AS w FROM qc JOIN f USING (term)), q AS (SELECT item_id, term, w / greatest(sqrt(sum(w * w) OVER (PARTITION BY item_id)), 1e-12) AS w FROM qr),
s AS (SELECT item_id, doc_id, round(sum(q.w * w.w), 6) AS score FROM q JOIN w USING (term) GROUP BY 1, 2)
SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s QUALIFY rank <= 5""")
def tfidf_retrieve(spark: SparkSession, d: str) -> DataFrame:
    """The five best documents for each question by lexical vectors."""
    counts, frequencies = lexical(spark, d)
    questions = W.term_counts(table(spark, d, "benchmark"), "item_id", "text")
    scored = W.lexical_scores(W.weights(questions, frequencies, "item_id"), W.weights(counts, frequencies, "doc_id"), "item_id", "doc_id").withColumn("score", F.round("score", 6))
    return W.top_k(scored, ["item_id"], 5, "doc_id")


def vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The queries of a search, every vector whose id is divisible by 20, and what is searched, all of them."""
    e = table(spark, d, "embeddings")
    return e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), "label")


NEAR = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, i.label, round(list_cosine_similarity(q.v, i.v), 6) AS score FROM e q, e i WHERE q.vec_id % 20 = 0 AND q.vec_id <> i.vec_id)
"""


@query(NEAR + "SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INT AS rank FROM s QUALIFY rank <= 5")
def knn_exact(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest vectors of each query, exactly."""
    queries, items = vectors(spark, d)
    return W.nearest(queries, items, 5, digits=6)


@query(NEAR + "SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INT AS rank FROM s WHERE label = 1 AND score >= 0.1 QUALIFY rank <= 5")
def knn_masked(spark: SparkSession, d: str) -> DataFrame:
    """The nearest of those that a filter lets through before, from a least score on."""
    queries, items = vectors(spark, d)
    return W.nearest(queries, items.where("label = 1"), 5, min_score=0.1, digits=6)


@query(NEAR + """, l AS (SELECT *, CASE WHEN label < 3 THEN 'institution' ELSE 'knowledge' END AS lane FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY query_id, lane ORDER BY score DESC, item_id) AS nth FROM l QUALIFY nth <= CASE WHEN lane = 'institution' THEN 3 ELSE 2 END)
SELECT query_id, item_id, lane, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id)::INT AS rank FROM k""")
def knn_lane_quota(spark: SparkSession, d: str) -> DataFrame:
    """Five places, three of them for one lane."""
    queries, items = vectors(spark, d)
    return W.nearest_by_lane(queries, items.withColumn("lane", F.when(F.col("label") < 3, "institution").otherwise("knowledge")), 5, "institution", digits=6)


@query(NEAR + "SELECT query_id, round(max(score), 4) AS best, max(score) < 0.45 AS weak FROM s GROUP BY query_id")
def weak_matches(spark: SparkSession, d: str) -> DataFrame:
    """Queries whose best hit is weak."""
    queries, items = vectors(spark, d)
    best = W.nearest(queries, items, 1)
    return best.select("query_id", F.round(F.round("score", 6), 4).alias("best"), (F.round("score", 6) < X.WEAK_MATCH).alias("weak"))


@query("SELECT count(*) AS vectors, count(DISTINCT len(embedding)) AS widths, count(*) FILTER (abs(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1) > 0.01) AS off FROM embeddings")
def norm_sanity(spark: SparkSession, d: str) -> DataFrame:
    """How many vectors there are, of how many widths, and how many are not of length 1."""
    v = F.col("embedding")
    return table(spark, d, "embeddings").agg(F.count(F.lit(1)).alias("vectors"), F.countDistinct(F.size(v)).alias("widths"), F.count_if(F.abs(F.sqrt(W.dot(v, v)) - 1) > 0.01).alias("off"))


@query(NEAR + """, k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS nth FROM s QUALIFY nth <= 3)
SELECT query_id, array_to_string(list('[' || nth || '] ' || CASE WHEN label < 3 THEN 'I' || label || ', STARS C-' || item_id || ' <u' || item_id || '>' ELSE 'S' || label || ' <u' || item_id || '>' END ORDER BY nth), chr(10) || chr(10)) AS block FROM k GROUP BY query_id""")
def context_block(spark: SparkSession, d: str) -> DataFrame:
    """The hits of each query as one numbered text with their sources."""
    hits = knn_exact(spark, d).where("rank <= 3").join(table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "label"), "item_id")
    label, item = F.col("label").cast("string"), F.col("item_id").cast("string")
    cited = T.citation(F.when(F.col("label") < 3, "institution").otherwise("knowledge"), F.concat(F.lit("I"), label), F.concat(F.lit("C-"), item), F.concat(F.lit("S"), label), F.concat(F.lit("u"), item))
    lines = F.array_sort(F.collect_list(F.struct("rank", F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), cited).alias("text"))))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(lines, lambda s: s["text"]), "\n\n").alias("block"))


EVENTS = """
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g'), '(?is)<nav\\b[^>]*>.*?</nav>', ' ', 'g') AS h FROM pages),
s AS (SELECT page_id, string_split(regexp_replace(h, '(?i)<(/?)(h1|h2|h3|h4|h5|p|li)\\b', chr(1) || '<\\1\\2', 'g'), chr(1)) AS parts FROM p), u AS (SELECT page_id, generate_subscripts(parts, 1) AS nth, unnest(parts) AS part FROM s),
o AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS ord, part FROM u WHERE regexp_matches(part, '(?i)^<(h1|h2|h3|h4|h5|p|li)\\b[^>]*>')),
e AS (SELECT page_id, ord::INT AS ord, lower(regexp_extract(part, '^<([A-Za-z0-9]+)', 1)) AS tag, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(part, '(?s)^<[^>]*>', ''), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[\\s\\x{a0}]+', ' ', 'g')) AS text FROM o)
"""


@query(EVENTS + "SELECT page_id, ord, tag, sha1(text) AS sha, last_value(CASE WHEN tag = 'h1' THEN text END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS heading FROM e")
def html_events(spark: SparkSession, d: str) -> DataFrame:
    """Headings, paragraphs and items of pages in order, under the heading they stand below."""
    rows = H.under_headings(H.events(table(spark, d, "pages"), "page_id", "html"), "page_id")
    return rows.select("page_id", "ord", "tag", F.sha1("text").alias("sha"), "heading")


@query("""
SELECT page_id, array_to_string(list_transform(list_filter(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), lambda h: h <> '' AND NOT regexp_matches(h, '^(#|mailto:|javascript:)')), lambda h: CASE WHEN starts_with(h, '/') THEN 'https://base.org' || h ELSE h END).list_transform(lambda h: trim(h)), ' ') AS links FROM pages
""")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    """Each page's links, made absolute."""
    p = table(spark, d, "pages")
    found = F.regexp_extract_all("html", F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    kept = F.filter(found, lambda h: (h != "") & ~h.rlike("^(#|mailto:|javascript:)"))
    return p.select("page_id", F.array_join(F.transform(kept, lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(F.lit("https://base.org"), h)).otherwise(h)), " ").alias("links"))


@query("""
SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), lambda h: h <> '' AND NOT regexp_matches(h, '^(#|mailto:|javascript:)')), lambda h: CASE WHEN starts_with(h, '/') THEN 'https://base.org' || h ELSE h END))), ' ') AS links FROM pages
""")
def html_distinct_links(spark: SparkSession, d: str) -> DataFrame:
    """Each page's different links, sorted."""
    return table(spark, d, "pages").select("page_id", F.array_join(F.array_sort(H.links(F.col("html"), "https://base.org")), " ").alias("links"))


@query("""
WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '[?#].*$', '') || '/OP/op-6/' ELSE regexp_replace(url, '[?#].*$', '') || '/files/Annual%20Report+1.PDF?x=1' END AS url FROM pages),
p AS (SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM u), s AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS seg FROM p)
SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host, path, coalesce(seg[-1], '') AS last, coalesce(seg[-3], '') AS third, lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1)) AS extension,
  substr(sha1(url), 1, 16) || CASE WHEN lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1)) = '.pdf' THEN '.pdf' ELSE '' END AS file, CASE WHEN page_id % 3 = 2 THEN 'Annual Report+1.PDF' WHEN regexp_extract(path, '[^/]*$') = '' THEN '(no filename)' ELSE regexp_extract(path, '[^/]*$') END AS original,
  page_id % 3 = 2 AS document FROM s
""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    """A URL's parts, and the name that its document is stored under."""
    bare = F.regexp_replace("url", "[?#].*$", "")
    k = F.col("page_id") % 3
    u = table(spark, d, "pages").select("page_id", F.when(k == 0, F.col("url")).when(k == 1, F.concat(bare, F.lit("/OP/op-6/"))).otherwise(F.concat(bare, F.lit("/files/Annual%20Report+1.PDF?x=1"))).alias("url"))
    url = F.col("url")
    segments = T.url_segments(url)
    return u.select(
        "page_id", T.url_host(url).alias("host"), T.url_path(url).alias("path"), F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit("")).alias("last"), F.coalesce(F.try_element_at(segments, F.lit(-3)), F.lit("")).alias("third"),
        T.url_extension(url).alias("extension"), T.local_name(url).alias("file"), T.original_name(url).alias("original"), T.is_document_url(url).alias("document"),
    )
