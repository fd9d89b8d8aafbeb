"""The disclosure pipeline end to end, on the declared shapes: scores, master, validation, chart tables,
content index, corpus chunks and their search. Each step is a plan; nothing is collected."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.sizes import sent_if_small
from lodestone.functions.stages import passing_folder, written
from lodestone.functions import fixed as X
from lodestone.functions import text as T
from lodestone.functions import values as V
from lodestone.functions.nulls import is_populated
from lodestone.operators import chunking, coverage, embedding, measures, vectors, writing
from lodestone.operators import joins as J
from lodestone.operators import narrative as narrate
from lodestone.sources import config, schemas, sinks

KEYS = ["institution", "credit_code"]


def combined(scores: list[tuple[str, DataFrame]]) -> DataFrame:
    """Scorecards in one: (version, rows of SCORES) of each, with the pillar of each code."""
    frames = [df.withColumn("stars_version", F.lit(v)).withColumn("pillar", V.pillar(F.col("credit_code"))) for v, df in scores]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return J.pick(out, schemas.COMBINED.fieldNames())


def master(scores: DataFrame, fields: DataFrame) -> DataFrame:
    """Credits beside their fields. Sum ``score`` over ``anchor`` alone: it repeats on each field."""
    order = [F.col("section").asc_nulls_last(), F.col("field").asc_nulls_last(), F.col("value").asc_nulls_last()]
    return J.outer_with_origin(scores, fields, KEYS, order)


def reconciliation(scores: DataFrame, fields: DataFrame, joined: DataFrame) -> DataFrame:
    """(check, expected, actual) of the joined table against its sides."""
    n = lambda df: df.agg(F.count(F.lit(1)).cast("double").alias("v"))
    total = lambda df: df.agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("v"))
    pairs = [
        ("orphan fields", n(fields.limit(0)), n(joined.where("not has_left"))),
        ("field rows", n(fields), n(joined.where("has_detail"))),
        ("anchors", n(scores), n(joined.where("anchor"))),
        ("anchored score", total(scores), total(joined.where("anchor"))),
    ]
    out = None
    for name, a, b in pairs:
        row = a.select(F.lit(name).alias("check"), F.col("v").alias("expected")).join(F.broadcast(b.select(F.col("v").alias("actual"))))
        out = row if out is None else out.unionByName(row)
    return out


def crosswalk(mapping: DataFrame) -> DataFrame:
    """A mapping in the names that the operators use; line is a row's place in its file, from 2."""
    names = {"stars_credit": "credit", "stars_field": "field", "gri_standard": "standard", "gri_disclosure": "disclosure"}
    return mapping.select("line", *[F.trim(k).alias(v) for k, v in names.items()], F.trim("relationship").alias("relationship"), F.trim("review_status").alias("review_status"), "rationale", "caveat")


def validated(mapping: DataFrame, vocabulary: DataFrame, joined: DataFrame) -> DataFrame:
    """(line, rule) for each rule that a row of the mapping breaks."""
    records = joined.select(F.col("credit_code").alias("credit"), "field")
    return J.violations(crosswalk(mapping), vocabulary, records, X.RELATIONSHIPS, X.REVIEW_STATES)


def records(joined: DataFrame) -> DataFrame:
    """The first answer of each institution to each field."""
    rows = joined.where("has_detail").select(F.col("institution").alias("entity"), F.col("credit_code").alias("credit"), F.trim("field").alias("field"), "value", "units", "value_type")
    return coverage.first_values(rows, ["entity", "credit", "field"], [F.col("value").asc_nulls_last(), F.col("units").asc_nulls_last()])


def bi_tables(joined: DataFrame, mapping: DataFrame, vocabulary: DataFrame, institutions: DataFrame, n_institutions: int, notes: Sequence[config.Note] = ()) -> dict[str, DataFrame]:
    """scores, metrics and coverage: a table for each grain. notes: known reasons why figures can't be read at face value."""
    named = crosswalk(mapping)
    keys = institutions.select("institution", "institution_key")
    detail = joined.where("has_detail").withColumnRenamed("credit_code", "credit").join(sent_if_small(keys), "institution", "left")
    entities = institutions.select(F.col("institution").alias("entity"))
    return {
        "scores": measures.scores(joined, keys),
        "metrics": measures.metrics(detail, named, n_institutions, notes=[(n.holds(), n.text) for n in notes]),
        "coverage": coverage.coverage(vocabulary, named, entities, records(joined)),
    }


def content_index(joined: DataFrame, mapping: DataFrame, vocabulary: DataFrame, institutions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a row for each institution and disclosure: title, status, detail, note and its place; the provenance of each value).

    The detail of what is reported is its fields' values; of a gap or a rejected match it says so. The
    note has the caveats and up to three fields that the institution leaves empty.
    """
    named, own = crosswalk(mapping), records(joined)
    entities = institutions.select(F.col("institution").alias("entity"))
    found = coverage.provenance(named, entities, own).join(own.select("entity", "credit", "field", "units"), ["entity", "credit", "field"])
    shown = F.struct("credit", "field", F.concat(F.lit("**"), F.col("field"), F.lit("**: "), V.cell(F.col("value"), F.col("units"))).alias("text"))
    lacking = F.struct("credit", "field", F.concat_ws(" / ", "credit", "field").alias("text"))
    texts = lambda c: F.transform(c, lambda s: s["text"])
    # a disclosure's mapped fields are as many as its mapping rows, whatever the records
    per = found.groupBy("entity", "disclosure").agg(F.array_sort(F.collect_list(F.when(F.col("populated"), shown))).alias("a"), F.array_sort(F.collect_list(F.when(~F.col("populated"), lacking))).alias("b"))
    confirmed = F.col("review_status") == "confirmed"
    said = named.where(confirmed & is_populated("caveat")).groupBy("disclosure").agg(F.array_sort(F.collect_list(F.struct("line", "caveat"))).alias("c"))
    caveats = said.select("disclosure", T.merge_sentences(F.transform("c", lambda s: s["caveat"])).alias("caveats"))
    first = lambda test: F.min_by(F.when(test, F.struct("credit", "field", "caveat")), F.when(test, F.col("line")))
    ended = named.groupBy("disclosure").agg(first(confirmed & (F.col("relationship") == "gap_gri_side")).alias("gap"), first(F.col("review_status") == "rejected").alias("rejected"), F.max(confirmed).alias("decided"))
    rows = coverage.coverage(vocabulary, named, entities, own, proposed="Not assessed").join(per, ["entity", "disclosure"], "left").join(caveats, "disclosure", "left").join(ended, "disclosure", "left")
    rows = rows.join(sent_if_small(vocabulary.select("disclosure", "title")), "disclosure") if "title" in vocabulary.columns else rows.withColumn("title", F.lit(None).cast("string"))
    missing = F.when((F.size("a") > 0) & (F.size("b") > 0), F.concat(F.lit("Not populated by this institution: "), F.array_join(F.slice(texts("b"), 1, 3), "; "), F.lit(".")))
    turned_down = ~F.coalesce("decided", F.lit(False)) & F.col("rejected").isNotNull()
    rejected = F.concat(F.lit("Assessed: the nearest field ("), F.concat_ws(" / ", "rejected.credit", "rejected.field"), F.lit(") was reviewed and rejected as an answer to this disclosure."))
    detail = F.when(F.col("gap").isNotNull(), "No data exists for this disclosure.").when(turned_down, rejected).otherwise(F.coalesce(F.array_join(texts("a"), "<br>"), F.lit("")))
    note = F.when(F.col("gap").isNotNull(), F.coalesce("gap.caveat", F.lit(""))).when(turned_down, F.coalesce("rejected.caveat", F.lit(""))).otherwise(F.concat_ws(" ", "caveats", missing))
    major, minor = V.compound_key(F.col("disclosure"))
    order = Window.partitionBy("entity").orderBy("standard", major, minor, "disclosure")
    return rows.select("entity", F.row_number().over(order).alias("place"), "standard", "disclosure", "title", "status", detail.alias("detail"), note.alias("note")), found


def rendered_index(rows: DataFrame, preamble: str = "") -> DataFrame:
    """(entity, markdown): a content index as a document: its counts by status, then a table for each standard, in order.

    rows: as of ``content_index``; an entity's are as many as the vocabulary has disclosures.
    """
    empty = lambda c: F.when(F.col(c) == "", "—").otherwise(F.col(c))
    shown = rows.withColumn("Disclosure", F.concat(F.lit("**"), F.col("disclosure"), F.lit("** "), F.coalesce("title", F.lit(""))))
    shown = shown.select("entity", "standard", "place", F.trim("Disclosure").alias("Disclosure"), F.col("status").alias("Status"), empty("detail").alias("Value or reason"), F.col("note").alias("Notes"))
    tables = sinks.markdown_tables(shown, ["entity", "standard"], ["place"], ["Disclosure", "Status", "Value or reason", "Notes"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("standard", "markdown"))), lambda p: F.concat(F.lit("## "), p["standard"], F.lit("\n\n"), p["markdown"]))
    body = tables.groupBy("entity").agg(F.array_join(parts, "\n\n").alias("_body"))
    counts = rows.groupBy("entity").agg(*[F.count_if(F.col("status") == s).alias(s) for s in X.STATUS_ORDER])
    head = F.concat(F.lit(f"| {' | '.join(X.STATUS_ORDER)} |\n|{'---|' * len(X.STATUS_ORDER)}\n"), sinks.markdown_row(*map(F.col, X.STATUS_ORDER)))
    title = F.concat(F.lit("# Content index — "), F.col("entity"))
    front = [title, F.lit(preamble), head] if preamble else [title, head]
    return body.join(counts, "entity").select("entity", F.concat_ws("\n\n", *front, "_body").alias("markdown"))


def corpus_chunks(corpus: DataFrame, flags: DataFrame, kinds: dict[str, str], parity: bool = True) -> DataFrame:
    """Chunks of a text corpus with what searches filter by. flags: source, flags; a small table. parity: how quantities are read, see ``has_quantity``."""
    rows = corpus.join(sent_if_small(flags), "source", "left").withColumn("scraper_flags", F.coalesce("flags", F.lit("")))
    rows = chunking.chunk_records(rows.withColumnRenamed("body", "text"), parity=parity)
    return rows.select(
        F.concat_ws("-", "source", F.col("chunk_index").cast("string")).alias("id"), F.col("chunk").alias("text"), F.lit("knowledge").alias("lane"), F.lit("").alias("institution"), "source", "url",
        config.looked_up(F.col("source"), kinds, "context").alias("source_type"), F.when(F.contains("scraper_flags", F.lit("FRENCH")), "fr").otherwise("en").alias("language"), "scraper_flags",
        "has_quantity", "chunk_index", "chars", "words", F.lit("").alias("pillar"),
    )


def _with_outcome(documents: DataFrame) -> DataFrame:
    rows = documents.where("extract_status = 'ok'").withColumn("extension", F.lower(F.regexp_extract("original_name", r"\.[^.]*$", 0)))
    return chunking.indexable(rows, order="ord")


def document_chunks(documents: DataFrame, institutions: DataFrame, parity: bool = True) -> DataFrame:
    """Chunks of institutions' own documents: no spreadsheets, none that is too large, each text once, by ``ord``.

    documents: ord, institution, original_name, local_file, url, credit_code, field, extract_status, text.
    A chunk begins with its document's name; its counts are those of the text alone. Documents of
    unknown institutions have none.
    """
    known = sent_if_small(institutions.select("institution", "institution_key"))
    rows = _with_outcome(documents).where("skipped is null").join(known, "institution")
    rows = chunking.chunk_records(rows, min_words=0, prefix=F.col("original_name"), parity=parity)
    name = F.concat_ws("::", F.lit("doc"), "institution_key", F.substring("local_file", 1, 12), F.lpad(F.col("chunk_index").cast("string"), 4, "0"))
    nothing = F.lit("")
    return rows.select(
        name.alias("id"), F.col("chunk").alias("text"), F.lit("institution").alias("lane"), "institution", "institution_key", F.substring("original_name", 1, 80).alias("source"), "url", F.lit("document").alias("source_type"),
        F.lit("en").alias("language"), nothing.alias("scraper_flags"), "credit_code", nothing.alias("credit_name"), nothing.alias("pillar"), nothing.alias("section"), F.substring("field", 1, 120).alias("field"),
        "has_quantity", "chunk_index", "chars", "words",
    )


def document_outcomes(documents: DataFrame) -> DataFrame:
    """(outcome, documents): how many extracted documents are indexed, or are left out as spreadsheets, oversized or duplicates."""
    return _with_outcome(documents).groupBy(F.coalesce("skipped", F.lit("indexed")).alias("outcome")).agg(F.count(F.lit(1)).alias("documents"))


def review(mapping: DataFrame, requirements: DataFrame, joined: DataFrame, lines: int = 9) -> DataFrame:
    """Each proposed row beside the first lines of what its disclosure asks for and what institutions say in its field.

    values: a line for each record of the field; reported of asked: how many have a value. Rows of
    gaps have none of these.
    """
    todo = crosswalk(mapping).join(mapping.select("line", "confidence"), "line").where("review_status = 'proposed'")
    asks = requirements.select(F.col("number").alias("disclosure"), "title", F.split("text", "\n").alias("_lines"))
    more = F.size("_lines") - lines
    shown = F.concat(F.array_join(F.slice("_lines", 1, lines), "\n"), F.when(more > 0, F.concat(F.lit("\n... "), more.cast("string"), F.lit(" more line(s)"))).otherwise(""))
    said = F.concat(F.col("institution"), F.lit(": "), F.when(is_populated("value"), F.concat_ws(" ", F.trim("value"), F.when(is_populated("units"), F.col("units")))).otherwise("not reported"))
    per = joined.where("has_detail").groupBy(F.col("credit_code").alias("credit"), F.trim("field").alias("field")).agg(
        F.array_join(F.array_sort(F.collect_list(said)), "\n").alias("values"), F.count_if(is_populated("value")).alias("reported"), F.count(F.lit(1)).alias("asked")
    )
    rows = todo.join(sent_if_small(asks), "disclosure", "left").join(per, ["credit", "field"], "left")
    return rows.select("line", "relationship", "confidence", "disclosure", "title", shown.alias("requirement"), "credit", "field", "values", "reported", "asked", "rationale", "caveat")


def amended(mapping: DataFrame, changes: DataFrame, inserts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the mapping with changes and new rows, how many rows had each outcome); see ``operators.joins.amend``."""
    rows = J.amend(mapping, changes, inserts, ["stars_credit", "stars_field", "gri_disclosure"])
    return rows.where("outcome <> 'missing'").select(*mapping.columns), rows.where("outcome <> 'kept'").groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


def candidate_fields(targets: DataFrame, joined: DataFrame, k: int = 6, least: float = 0.0) -> DataFrame:
    """(disclosure, credit, field, sample, n_institutions, rank, score): fields whose texts are nearest to what a disclosure asks for, by lexical vectors.

    targets: disclosure, title, text; see ``operators.embedding.targets``.
    """
    order = F.struct("institution", "section", "value")
    rows = joined.where("has_detail").select(F.col("credit_code").alias("credit"), "field", "institution", "credit_name", "value", order.alias("ord"))
    fields = embedding.field_corpus(rows).withColumn("id", F.concat_ws(" / ", "credit", "field"))
    asked = targets.select(F.col("disclosure").alias("query_id"), embedding.query_text().alias("text"))
    hits = search(fields, asked, k).where(F.col("score") >= least)
    return hits.join(fields.drop("text"), "id").select(F.col("query_id").alias("disclosure"), "credit", "field", "sample", "n_institutions", "rank", "score")


def lexical_passages(
    sections: DataFrame, entities: DataFrame, chunks: DataFrame, references: str | T.ReferenceFinder, style_k: int = narrate.STYLE_K, evidence_k: int = narrate.EVIDENCE_K, least: float = narrate.LEAST_SCORE, digits: int | None = None
) -> DataFrame:
    """Facts of kind evidence and style for each section of each entity, by lexical vectors; see ``operators.narrative.passages`` for their shape.

    A section asks with its title and brief. Evidence comes from an entity's own chunks alone, style from the knowledge lane
    without peer reports, other languages and quantities; both from ``least`` on, and with figures blanked out. ``digits``: scores are
    rounded before they are compared, so that ties don't hang on the order of sums.
    sections: section, title, and a brief if there is one; a few. entities: entity; chunks: as of ``corpus_chunks`` and ``document_chunks``.
    """
    brief = F.col("brief") if "brief" in sections.columns else F.lit(None).cast("string")
    asked = sections.select(F.col("section").alias("query_id"), F.concat_ws(". ", "title", brief).alias("text")).dropDuplicates(["query_id"])
    frequencies = written(vectors.document_frequencies(vectors.term_counts(chunks, "id", "text"), chunks.count()))
    style = search(vectors.allowed(chunks, drop_quantities=True), asked, style_k, digits=digits, frequencies=frequencies).join(sent_if_small(entities.select("entity")))
    own = chunks.where("lane = 'institution'").join(sent_if_small(entities.select(F.col("entity").alias("institution"))), "institution", "left_semi")
    counts = vectors.term_counts(own, "id", "text")
    questions = written(vectors.weights(vectors.term_counts(asked, "query_id", "text"), frequencies, "query_id"))
    scored = vectors.lexical_scores(questions, vectors.weights(counts, frequencies, "id"), "query_id", "id").join(own.select("id", F.col("institution").alias("entity")).distinct(), "id")
    scored = scored if digits is None else scored.withColumn("score", F.round("score", digits))
    evidence = vectors.top_k(scored, ["query_id", "entity"], evidence_k, "id")
    out = None
    for kind, hits, chars in (("evidence", evidence, narrate.CONTEXT_CHARS), ("style", style, narrate.STYLE_CHARS)):
        found = chunks.select("id", "source", F.substring("text", 1, chars).alias("_text")).join(sent_if_small(written(hits.where(F.col("score") >= least))), "id")
        nothing = F.lit(None).cast("string")
        rows = found.select(
            "entity", F.col("query_id").alias("section"), F.lit(kind).alias("kind"), F.lpad(F.col("rank").cast("string"), 3, "0").alias("disclosure"), nothing.alias("credit"), nothing.alias("field"), nothing.alias("token"),
            F.concat(F.lit("["), F.coalesce("source", F.lit("")), F.lit("] "), T.redact_figures(F.col("_text"), references)).alias("text"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def narrative(
    found: DataFrame, titles: DataFrame, writer: narrate.Writer, system: str, references: str | T.ReferenceFinder, cache: DataFrame | None = None, ledger: str | None = None, limits: writing.Limits = writing.Limits(), fresh: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(sections written, rendered and audited; the cache with what was written now).

    found: as of ``operators.narrative.facts``; titles: section, title and brief, as many as a report has. Prompts that the cache (of
    ``operators.writing``) lacks go to the writer, in tasks and within ``limits``: see ``written_now``. Sections that it leaves aren't among the rows.
    """
    cache = found.sparkSession.createDataFrame([], writing.CACHE) if cache is None else cache
    asked = narrate.prompts(found, titles)
    new = written_now(found, asked, writer, system, cache, ledger, limits, fresh)
    added = new.where("status = 'written'").select("key", "prose", "model", "prompt_sha256", "generated", F.lit("now").alias("run"))
    cache = (cache.join(added.select("key", "prompt_sha256"), ["key", "prompt_sha256"], "left_anti") if fresh else cache).unionByName(added, allowMissingColumns=True)
    have, _ = narrate.to_write(asked, cache, system)
    return sections_of(found, have, titles, references), cache


def written_now(found: DataFrame, asked: DataFrame, writer: narrate.Writer, system: str, cache: DataFrame, ledger: str | None = None, limits: writing.Limits = writing.Limits(), fresh: bool = False) -> DataFrame:
    """What a writer made of those of the prompts (entity, section, prompt) that the cache lacks, or of all if ``fresh``: rows of ``writing.RESULTS``.

    ledger: the folder in which calls are counted, so that a day's quota holds over runs; without one it holds for this call alone.
    """
    tokens = found.where("token is not null").groupBy("entity", "section").agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    wanted = asked.join(tokens, ["entity", "section"], "left")
    _, lacking = narrate.to_write(wanted, cache.limit(0) if fresh else cache, system)
    whose = re.sub(r"[^A-Za-z0-9._-]", "_", getattr(writer, "model", writer.name))
    if ledger is not None:
        return writing.write_prompts(lacking, lambda: writer, system, writing.Ledger(ledger), limits, fresh, whose=whose)
    with passing_folder(found.sparkSession, "ledger") as at:
        return writing.write_prompts(lacking, lambda: writer, system, writing.Ledger(at), limits, fresh, whose=whose)


def sections_of(found: DataFrame, have: DataFrame, titles: DataFrame, references: str | T.ReferenceFinder) -> DataFrame:
    """Written sections (entity, section, prose, model) rendered and audited, beside the figures and texts that they were written from."""
    figures = found.where("kind = 'figure'").groupBy("entity", "section").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("token", "text")))).alias("figures"))
    context = found.where("kind <> 'figure' and text is not null").groupBy("entity", "section").agg(F.collect_set("text").alias("context"))
    rows = have.join(figures, ["entity", "section"], "left").join(context, ["entity", "section"], "left").join(sent_if_small(titles), "section")
    rows = rows.withColumn("figures", F.coalesce("figures", F.create_map().cast("map<string,string>"))).withColumn("context", F.coalesce("context", F.array().cast("array<string>")))
    return narrate.finished(rows.withColumnRenamed("prose", "template"), references)


def full_reports(sections: DataFrame, order: DataFrame, index: DataFrame, preamble: str = "") -> DataFrame:
    """(entity, markdown): front matter with what the audit found, the sections in order, the content index and how to check it.

    sections: entity, section, title, rendered, model, and the audit's arrays; order: section, place; index: entity, markdown (of ``rendered_index``),
    whose first four lines, its own title, are left out. A report has as many sections as its outline.
    """
    placed = sections.join(sent_if_small(order), "section")
    body = F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat(F.lit("## "), F.col("title"), F.lit("\n\n"), F.trim("rendered")).alias("text")))), lambda p: p["text"])
    per = placed.groupBy("entity").agg(
        F.array_join(body, "\n\n").alias("_body"), F.count(F.lit(1)).alias("_sections"), F.array_join(F.array_sort(F.collect_set("model")), ", ").alias("_models"), F.sum(F.size("invented")).alias("_invented"), F.sum(F.size("review")).alias("_review"),
    )
    facts = F.concat(F.lit("| Sections | Written by | Figures to review | Figures without a source |\n|---|---|---|---|\n"), sinks.markdown_row(F.col("_sections"), F.col("_models"), F.col("_review"), F.col("_invented")))
    rows = per.join(index.select("entity", F.col("markdown").alias("_index")), "entity")
    title = F.concat(F.lit("# Sustainability report — "), F.col("entity"))
    front = F.concat_ws("\n\n", title, *([F.lit(preamble)] if preamble else []), facts, F.lit("---"), F.col("_body"), F.lit("---\n\n# Content index"))
    check = F.lit("---\n\n## Checking this report\n\nEach figure comes from one field of one record, which the provenance table names.\n")
    return rows.select("entity", F.concat_ws("\n\n", sinks.assembled(F.array("_index"), front), check).alias("markdown"))


def search(chunks: DataFrame, queries: DataFrame, k: int = 5, first_lane: str | None = None, corpus: DataFrame | None = None, digits: int | None = None, frequencies: DataFrame | None = None) -> DataFrame:
    """The k best chunks for each query (query_id, text) by lexical vectors; filter the chunks before (``vectors.allowed``). ``first_lane`` has ceil(k / 2) places.

    corpus: what terms are weighed by, with what is filtered out; the chunks themselves by default; frequencies: its terms' weights, where they are known.
    digits: places that scores are rounded to before they are compared.
    """
    counts = vectors.term_counts(chunks, "id", "text")
    if frequencies is None:
        every = chunks if corpus is None else corpus
        frequencies = written(vectors.document_frequencies(vectors.term_counts(every, "id", "text"), every.count()))
    asked = vectors.weights(vectors.term_counts(queries, "query_id", "text"), frequencies, "query_id")
    scored = vectors.lexical_scores(asked, vectors.weights(counts, frequencies, "id"), "query_id", "id")
    scored = scored if digits is None else scored.withColumn("score", F.round("score", digits))
    if first_lane is None:
        return vectors.top_k(scored, ["query_id"], k, "id")
    return vectors.lane_quota(scored.join(chunks.select("id", "lane"), "id").withColumnRenamed("id", "item_id"), k, first_lane).withColumnRenamed("item_id", "id")


def evaluated(chunks: DataFrame, questions: DataFrame, k: int = 3, corpus: DataFrame | None = None) -> DataFrame:
    """(question, best, source, weak, hit) of each question: the best score and its source, whether it is weak, and whether an expected source is among the k.

    questions: question, and expected (a source, or null). A question without any hit is weak.
    """
    asked = questions.select("question", "expected").withColumn("query_id", F.col("question")).withColumn("text", F.col("question"))
    hits = search(chunks, asked.select("query_id", "text"), k, corpus=corpus).join(chunks.select("id", "source"), "id")
    per = hits.groupBy("query_id").agg(F.max("score").alias("best"), F.max_by("source", F.struct("score", -F.col("rank"))).alias("source"), F.collect_set("source").alias("_sources"))
    rows = asked.join(per, "query_id", "left")
    found = F.when(F.col("expected").isNotNull(), F.coalesce(F.array_contains("_sources", F.col("expected")), F.lit(False)))
    return rows.select("question", "best", "source", (F.coalesce("best", F.lit(0.0)) < X.WEAK_MATCH).alias("weak"), found.alias("hit"))


def built_index(chunks: DataFrame, embedder: embedding.ModelEmbedder | embedding.LexicalEmbedder) -> DataFrame:
    """The chunks with their vectors and the name of what made them, as ``sinks.write_index`` writes them: an index is searched by its own backend alone."""
    return chunks.withColumnRenamed("id", "item_id").join(embedder.encode(chunks, "id", "text").withColumnRenamed("id", "item_id"), "item_id")
