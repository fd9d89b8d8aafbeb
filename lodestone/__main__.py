"""python -m lodestone COMMAND ...: the steps of the disclosure pipeline from and to files."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import flows
from lodestone.functions import markdown
from lodestone.functions import text as T
from lodestone.functions.stages import written
from lodestone.operators import embedding, narrative, pages, requirements, vectors, writing
from lodestone.operators import joins as J
from lodestone.operators.references import references_of
from lodestone.sources import files, schemas, sinks
from lodestone.sources.config import Institution, institutions

#: What a writer is told beside a section's facts.
SYSTEM = "Write the section in plain prose. State figures by their tokens alone, never a number of your own."


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """A mapping file's rows with their line numbers, from 2, below the header; a folder's files follow each other by name."""
    return files.read_csv(spark, path, schemas.MAPPING, "line").withColumn("line", F.col("line") + 2)


def named(place: str) -> Callable:
    """What MODULE:NAME stands for; ImportError if there is no such thing."""
    module, _, name = place.partition(":")
    try:
        return getattr(importlib.import_module(module), name)
    except AttributeError as e:
        raise ImportError(f"{module} has no {name}") from e


def narrate(spark: SparkSession, a: argparse.Namespace, mapping: DataFrame) -> int:
    """The sections of a narrative, from facts, evidence and style, by cache and writer; 1 if they aren't whole."""
    listed = spark.read.csv(a.sections, header=True, multiLine=True, escape='"')
    listed = listed if "brief" in listed.columns else listed.withColumn("brief", F.lit(None).cast("string"))
    vocabulary = files.read_vocabulary(spark, a.vocabulary)
    sections = listed.where(F.col("section") == a.section) if a.section else listed
    titles = sections.groupBy("section").agg(F.min("title").alias("title"), F.min("brief").alias("brief"))
    references = references_of(vocabulary)
    found = narrative.facts(sections.select("section", "disclosure"), flows.crosswalk(mapping), flows.records(sinks.read_published(spark, a.master)), references)
    if a.chunks:
        chunks = files.read_json_lines(spark, a.chunks, schemas.CHUNK)
        found = found.unionByName(flows.lexical_passages(titles, found.select("entity").distinct(), chunks, references))
    found = written(found)
    writer = (narrative.WRITERS[a.writer] if a.writer in narrative.WRITERS else named(a.writer))()
    given = {k: getattr(a, k) for k in ("per_day", "pace", "attempts", "writers") if getattr(a, k) is not None}
    # what stands in for a writer costs nothing
    limits = writing.Limits(**({"per_day": 100_000, "pace": 0.0} if a.writer in narrative.WRITERS else {}) | given)
    cache = writing.remembered(spark, a.cache) if a.cache else spark.createDataFrame([], writing.CACHE)
    asked = narrative.prompts(found, titles)
    new = flows.written_now(found, asked, writer, SYSTEM, cache, a.ledger or (a.cache and f"{a.cache}-ledger"), limits, a.no_cache)
    writing.counted(new).orderBy("status").show()
    if a.cache:
        writing.remember(new, a.cache)
    done = new.where("status = 'written'").select("key", "prose", "model", "prompt_sha256")
    have, lacking = narrative.to_write(asked, cache.select("key", "prose", "model", "prompt_sha256").join(done.select("key", "prompt_sha256"), ["key", "prompt_sha256"], "left_anti").unionByName(done), SYSTEM)
    rows = flows.sections_of(found, have, titles, references).select("entity", "section", "title", "rendered", "model", "invented", "review", "spelled", "publishable")
    missing = lacking.limit(1).count() > 0
    # prose of a stub, one section alone, or with figures that nobody reported, is never published
    whole = {
        "audited": lambda df: not df.where("not publishable").limit(1).count(),
        "written by a model": lambda df: not df.where("model in ('stub', 'rogue')").limit(1).count(),
        "complete": lambda _: not missing and not a.section,
    }
    goal = sinks.guarded_write(rows, a.out, whole, f"{a.out}.preview")
    print(goal)
    return int(missing)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lodestone", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *needs: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for n in needs:
            p.add_argument(f"--{n}", required=True)
        return p

    command("combine", "out").add_argument("scores", nargs="+", help="VERSION=FILE")
    command("master", "scores", "fields", "out")
    command("scores", "pages", "out").add_argument("--institution", required=True)
    command("fields", "pages", "out").add_argument("--institution", required=True)
    command("validate", "mapping", "vocabulary", "master")
    for name in ("bi", "index"):
        command(name, "mapping", "vocabulary", "master", "out").add_argument("--institution", action="append", required=True, help="KEY=NAME")
    p = command("chunk", "corpus", "out")
    p.add_argument("--summary")
    p.add_argument("--manifest")
    p.add_argument("--documents", help="folder of the manifest's documents as text")
    p.add_argument("--institution", action="append", default=[], help="KEY=NAME")
    command("requirements", "pages", "vocabulary", "retrieved", "out")
    command("review", "mapping", "master", "requirements")
    p = command("amend", "mapping", "changes", "inserts", "out")
    p.add_argument("--write", action="store_true", help="else the outcomes are shown and nothing is written")
    p = command("candidates", "master", "mapping", "vocabulary")
    p.add_argument("--requirements")
    p.add_argument("--all", action="store_true")
    p.add_argument("--disclosure", action="append")
    p.add_argument("-k", type=int, default=6)
    p = command("narrative", "mapping", "vocabulary", "master", "sections", "out")
    p.add_argument("--writer", default="stub", help="stub, rogue, or MODULE:FACTORY of your own")
    p.add_argument("--cache", help="folder of what was written before; what is written now is added")
    p.add_argument("--no-cache", action="store_true", help="write every section anew")
    p.add_argument("--section", help="this one alone, as a preview")
    p.add_argument("--chunks", help="chunks for evidence and style")
    p.add_argument("--ledger", help="folder in which calls are counted; by default below the cache")
    for name, kind in (("per-day", int), ("pace", float), ("attempts", int), ("writers", int)):
        p.add_argument(f"--{name}", type=kind)
    p = command("report", "narrative", "index", "sections", "out")
    p.add_argument("--html", action="store_true")
    p = command("index-chunks", "chunks", "out")
    p.add_argument("--backend", default="auto", help="auto, tfidf, or MODULE:FACTORY of an embedder")
    for name in ("search", "evaluate"):
        p = command(name, "chunks")
        p.add_argument("query" if name == "search" else "questions")
        p.add_argument("-k", type=int, default=5 if name == "search" else 3)
        p.add_argument("--lane", choices=["knowledge", "institution", "all"], default="knowledge")
        p.add_argument("--institution", help="a key, or a part that only one name has")
        p.add_argument("--pillar", action="append")
        p.add_argument("--source-type", action="append")
        p.add_argument("--min-score", type=float, default=0.0)
        p.add_argument("--include-peer-reports", action="store_true")
        p.add_argument("--any-language", action="store_true")
        p.add_argument("--drop-quantities", action="store_true")
    a = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("lodestone").getOrCreate()
    pairs = lambda values: [v.split("=", 1) for v in values]
    mapping = lambda: numbered(spark, a.mapping)
    if a.command == "combine":
        sinks.write_table(flows.combined([(v, files.read_csv(spark, f, schemas.SCORES)) for v, f in pairs(a.scores)]), a.out)
    elif a.command in ("scores", "fields"):
        cached = files.read_pages(spark, a.pages).withColumn("institution", F.lit(a.institution))
        rows = pages.scorecard(cached) if a.command == "scores" else pages.fields(cached, code="key").drop("ord")
        sinks.write_csv(rows, a.out)
    elif a.command == "master":
        scores, fields = spark.read.parquet(a.scores), files.read_csv(spark, a.fields, schemas.FIELDS)
        joined = flows.master(scores, fields)
        whole = {"reconciled": lambda df: not flows.reconciliation(scores, fields, df).where("expected <> actual").limit(1).count()}
        sinks.guarded_write(joined, a.out, whole)
    elif a.command == "validate":
        found = flows.validated(mapping(), files.read_vocabulary(spark, a.vocabulary), sinks.read_published(spark, a.master))
        found.orderBy("line", "rule").show(1000, False)
        return int(found.where("rule not like 'warning%'").limit(1).count() > 0)
    elif a.command in ("bi", "index"):
        known = [Institution(k, n) for k, n in pairs(a.institution)]
        tables = sinks.read_published(spark, a.master), mapping(), files.read_vocabulary(spark, a.vocabulary), institutions(spark, known)
        if a.command == "bi":
            for name, df in flows.bi_tables(*tables, len(known)).items():
                sinks.write_table(df, f"{a.out}/{name}")
        else:
            rows, found = flows.content_index(*tables)
            sinks.write_table(rows, f"{a.out}/index")
            flows.rendered_index(rows).select("markdown").write.mode("overwrite").text(f"{a.out}/markdown", lineSep="\n\n")
            sinks.write_table(found, f"{a.out}/provenance")
    elif a.command == "chunk":
        flags = spark.read.csv(a.summary, header=True, multiLine=True, escape='"').select("source", "flags") if a.summary else spark.createDataFrame([], "source string, flags string")
        rows = flows.corpus_chunks(files.read_corpus(spark, a.corpus), flags, {})
        if a.manifest:
            listed = files.read_manifest(spark, a.manifest, a.documents)
            rows = J.uniform([rows, flows.document_chunks(listed, institutions(spark, [Institution(k, n) for k, n in pairs(a.institution)]))])
            flows.document_outcomes(listed).orderBy("outcome").show()
        sinks.write_json_lines(rows, a.out)
    elif a.command == "requirements":
        found = requirements.extract_requirements(files.read_pages(spark, a.pages), "key", "html")
        vocabulary = files.read_vocabulary(spark, a.vocabulary)
        rows = found.join(vocabulary.select(F.col("disclosure").alias("number"), "standard"), "number", "left").withColumn("cached_source", F.col("key")).drop("key")
        sinks.write_requirements(rows, a.out, ["Requirement text as its pages state it."], a.retrieved)
        requirements.cross_check(found, vocabulary).orderBy("number", "finding").show(1000, False)
    elif a.command == "review":
        rows = flows.review(mapping(), files.read_requirements(spark, a.requirements), sinks.read_published(spark, a.master))
        rows.orderBy("line").show(1000, False, vertical=True)
    elif a.command == "amend":
        plain = [files.read_csv(spark, f, schemas.MAPPING) for f in (a.mapping, a.changes, a.inserts)]
        rows, counts = flows.amended(*plain)
        counts.orderBy("outcome").show()
        if a.write:
            sinks.write_csv(rows, a.out)
    elif a.command == "candidates":
        asked = embedding.targets(files.read_vocabulary(spark, a.vocabulary), flows.crosswalk(mapping()), a.disclosure, a.all)
        texts = files.read_requirements(spark, a.requirements).select(F.col("number").alias("disclosure"), "text") if a.requirements else spark.createDataFrame([], "disclosure string, text string")
        flows.candidate_fields(asked.join(texts, "disclosure", "left"), sinks.read_published(spark, a.master), a.k).orderBy("disclosure", "rank").show(1000, False)
    elif a.command == "narrative":
        return narrate(spark, a, mapping())
    elif a.command == "report":
        sections = sinks.read_published(spark, a.narrative)
        order = files.with_ordinal(spark.read.csv(a.sections, header=True), "place").groupBy("section").agg(F.min("place").alias("place"))
        reports = flows.full_reports(sections, order, spark.read.parquet(f"{a.index}/index").transform(flows.rendered_index))
        sinks.write_table(reports.withColumn("html", markdown.page(F.col("entity"), F.col("markdown"))) if a.html else reports, a.out)
    elif a.command == "index-chunks":
        chunks = files.read_json_lines(spark, a.chunks, schemas.CHUNK)
        own = [] if a.backend in ("auto", "tfidf") else [lambda: named(a.backend)()]
        embedder = embedding.first_available([*own, lambda: embedding.LexicalEmbedder.fit(chunks, "id", "text")])
        print(embedder.name)
        sinks.write_index(flows.built_index(chunks, embedder), a.out)
    else:
        chunks = files.read_json_lines(spark, a.chunks, schemas.CHUNK)
        who = a.institution and embedding.resolve_name(a.institution, {r[0] or r[1]: r[1] for r in chunks.where("lane = 'institution'").select("institution_key", "institution").distinct().collect()})
        shown = vectors.allowed(chunks, a.lane, who, not a.include_peer_reports, None if a.any_language else "en", a.drop_quantities, a.source_type, a.pillar)
        if a.command == "evaluate":
            questions = spark.read.csv(a.questions, header=True, schema="question string, expected string", multiLine=True, escape='"')
            found = flows.evaluated(shown, questions, a.k, chunks)
            found.orderBy("question").show(1000, False)
            found.agg(F.count(F.lit(1)).alias("questions"), F.count_if("weak").alias("weak"), F.count_if("hit").alias("hits")).show()
        else:
            asked = spark.createDataFrame([(0, a.query)], "query_id int, text string")
            if asked.where(T.out_of_scope(F.col("text"))).count():
                print("These chunks explain; what a standard says word for word, the requirements have.")
            hits = flows.search(shown, asked, a.k, "institution" if a.lane == "all" else None, chunks).where(F.col("score") >= a.min_score)
            hits.select("id", "rank", "score").join(shown, "id").select("rank", F.round("score", 3).alias("score"), "lane", "source", "url", F.substring("text", 1, 80).alias("text")).orderBy("rank").show(a.k, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
