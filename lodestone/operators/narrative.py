"""From facts to audited prose: gathering, prompts, cached sections, strict rendering, audit."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.sizes import sent_if_small
from lodestone.functions import fixed as X
from lodestone.functions import text as T
from lodestone.functions import values as V
from lodestone.functions.nulls import is_populated
from lodestone.operators import vectors as W
from lodestone.operators.joins import keep

#: Value types that reach prose through a token, and how much of a longer text serves as context.
TOKENISED, CONTEXT_CHARS = ("number", "year"), 600
#: Passages of a section's own evidence and of others' style, their least score, and how much of a style passage is shown.
EVIDENCE_K, STYLE_K, LEAST_SCORE, STYLE_CHARS = 4, 3, 0.35, 700


def facts(sections: DataFrame, mapping: DataFrame, records: DataFrame, references: str | T.ReferenceFinder) -> DataFrame:
    """What each (entity, section) can say: (entity, section, kind, disclosure, credit, field, token, text).

    kind: figure (with a token unique in its section), context (prose, cut), unavailable (mapped, not
    populated), gap (why there is no data) or caveat; the latter two with figures blanked out. A figure
    carries its unit, a percent sign or what its field counts.
    sections: section, disclosure. records: entity, credit, field, value, units, value_type; repeated
    fields count once, by their first value.
    """
    rows = sections.join(mapping.where("review_status = 'confirmed'"), "disclosure")
    gaps = rows.where("relationship = 'gap_gri_side'").groupBy("section", "disclosure").agg(F.min(F.struct("line", F.coalesce("rationale", F.lit("")).alias("why"))).alias("_first"))
    gaps = gaps.select("section", "disclosure", T.redact_figures(F.col("_first.why"), references).alias("text"))
    # rows of a mapping that say the same are one before they meet the entities
    used = rows.where(F.col("relationship").isin(*X.ANSWERS)).select("section", "disclosure", "credit", "field", "caveat").distinct().join(gaps.select("section", "disclosure"), ["section", "disclosure"], "left_anti")
    entities = records.select("entity").distinct()
    first = keep(records, ["entity", "credit", "field"], [F.col("value").asc_nulls_last()])
    grid = used.join(sent_if_small(entities)).join(first, ["entity", "credit", "field"], "left")
    said = is_populated("value")
    figure = said & F.col("value_type").isin(*TOKENISED)
    base = ["entity", "section", "disclosure", "credit", "field"]
    figures = T.unique_slugs(grid.where(figure), ["entity", "section"], ["credit", "field"])
    shown = lambda kind, df, text, token=None: df.select(*base, F.lit(kind).alias("kind"), (F.col(token) if token else F.lit(None).cast("string")).alias("token"), text.alias("text"))
    cut = F.when(F.length("value") > CONTEXT_CHARS, F.concat(F.substring("value", 1, CONTEXT_CHARS), F.lit(" […]"))).otherwise(F.col("value"))
    nothing = F.lit(None).cast("string")
    out = [
        shown("figure", figures, V.with_unit(F.col("field"), F.trim("value"), F.coalesce("units", F.lit(""))), "token"),
        shown("context", grid.where(said & ~F.col("value_type").isin(*TOKENISED)), cut),
        shown("unavailable", grid.where(~F.coalesce(said, F.lit(False))), nothing),
        shown("caveat", grid.where(F.coalesce(said, F.lit(False)) & is_populated("caveat")), T.redact_figures(F.trim("caveat"), references)),
        shown("gap", gaps.join(sent_if_small(entities)).withColumn("credit", nothing).withColumn("field", nothing), F.col("text")),
    ]
    rows = out[0]
    for part in out[1:]:
        rows = rows.unionByName(part)
    return rows.select("entity", "section", "kind", "disclosure", "credit", "field", "token", "text").distinct()


def passages(sections: DataFrame, index: DataFrame, embedded: DataFrame, institution: str, references: str | T.ReferenceFinder, style_k: int = STYLE_K, evidence_k: int = EVIDENCE_K, least: float = LEAST_SCORE) -> DataFrame:
    """Facts of kind evidence and style for each section of one institution, figures blanked out; see ``facts``.

    Evidence comes from the institution's own lane, style from the knowledge lane without quantities;
    both from ``least`` on. sections: section; embedded: query_id (the section), query; index: as
    of ``vectors.retrieve``, with source and text.
    """
    out = None
    for kind, k, chars, more in (("evidence", evidence_k, CONTEXT_CHARS, {"lane": "institution", "institution": institution}), ("style", style_k, STYLE_CHARS, {"drop_quantities": True})):
        hits = W.retrieve(embedded, index, k=k, min_score=least, **more).join(index.select("item_id", "source", "text"), "item_id")
        text = F.concat(F.lit("["), F.col("source"), F.lit("] "), T.redact_figures(F.substring("text", 1, chars), references))
        nothing = F.lit(None).cast("string")
        rows = hits.join(sections.select(F.col("section").alias("query_id")).distinct(), "query_id").select(
            F.lit(institution).alias("entity"), F.col("query_id").alias("section"), F.lit(kind).alias("kind"), F.lpad(F.col("rank").cast("string"), 3, "0").alias("disclosure"),
            nothing.alias("credit"), nothing.alias("field"), nothing.alias("token"), text.alias("text"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def prompts(found: DataFrame, titles: DataFrame) -> DataFrame:
    """(entity, section, prompt): a section's facts as lines by kind; figures by token, never by value.

    titles: section, title and, if sections have one, a brief of what each has to cover.
    """
    label = F.concat_ws(" ", F.col("disclosure"), F.concat(F.lit("("), F.concat_ws(" / ", "credit", "field"), F.lit(")")))
    body = F.when(F.col("kind") == "figure", F.concat(F.lit("{{ "), F.col("token"), F.lit(" }}"))).otherwise(F.coalesce("text", F.lit("not available")))
    line = F.struct(F.array_position(F.array(*map(F.lit, ["figure", "context", "evidence", "style", "caveat", "gap", "unavailable"])), F.col("kind")).alias("a"), "disclosure", "credit", "field", F.concat(F.upper("kind"), F.lit(" "), label, F.lit(": "), body).alias("text"))
    lines = found.groupBy("entity", "section").agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    title = F.concat(F.lit("# "), F.col("title"), F.lit(" — "), F.col("entity").cast("string"))
    brief = [F.when(is_populated("brief"), F.concat(F.lit("COVER: "), F.trim("brief")))] if "brief" in titles.columns else []
    return lines.join(sent_if_small(titles), "section").select("entity", "section", F.concat_ws("\n", title, *brief, F.array_join(F.transform("_lines", lambda r: r["text"]), "\n")).alias("prompt"))


def cache_key(system: Column, prompt: Column) -> Column:
    """Where a written section is kept: by its prompt, not by its writer or the figures' values."""
    return F.substring(F.sha2(F.concat(system, F.lit("\0"), prompt), 256), 1, 8)


def to_write(asked: DataFrame, cache: DataFrame, system: str) -> tuple[DataFrame, DataFrame]:
    """(sections that the cache has, those that it lacks); cache: key, prose, model and prompt_sha256.

    Keys have 32 bits, so among many prompts some share one: the hash of the whole prompt tells them apart. A row without that hash,
    as files without a header have none, counts where its key has no row with one.
    """
    keyed = asked.withColumn("key", cache_key(F.lit(system), F.col("prompt")))
    if "prompt_sha256" not in cache.columns:
        return keyed.join(cache, "key"), keyed.join(cache, "key", "left_anti")
    stated = F.col("prompt_sha256").isNotNull()
    kept = cache.withColumn("_stated", F.max(stated).over(Window.partitionBy("key"))).where(stated | ~F.col("_stated")).drop("_stated").withColumnRenamed("key", "_key")
    same = (F.col("key") == F.col("_key")) & F.coalesce(F.col("prompt_sha256") == F.sha2("prompt", 256), F.lit(True))
    return keyed.join(kept, same).drop("_key"), keyed.join(kept, same, "left_anti")


def missing_disclosures(sections: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(disclosure, side): what no section covers (right), or sections name and the vocabulary lacks (left)."""
    from lodestone.operators.joins import two_way_difference

    return two_way_difference(sections, vocabulary, "disclosure")


class Writer(Protocol):
    """Turns a prompt into a template whose figures are tokens. Raises ``writing.Busy`` where it is worth asking again, and
    ``writing.QuotaExhausted`` where it isn't until another day; ``model``, if there is one, says what wrote."""

    name: str

    def write(self, system: str, prompt: str, tokens: Sequence[str]) -> str: ...


class StubWriter:
    """Words without meaning around the first tokens; runs everything behind it."""

    name = "stub"

    def write(self, system: str, prompt: str, tokens: Sequence[str]) -> str:
        return "\n".join(["Placeholder prose, written offline.", *[f"One reported value is {{{{ {t} }}}}." for t in tokens[:4]]])


class RogueWriter:
    """Invents figures; the audit has to find them."""

    name = "rogue"

    def write(self, system: str, prompt: str, tokens: Sequence[str]) -> str:
        return "Emissions fell by 31,337 tons, or 19 percent, in one year."


WRITERS: dict[str, type] = {w.name: w for w in (StubWriter, RogueWriter)}


def finished(sections: DataFrame, references: str | T.ReferenceFinder) -> DataFrame:
    """Rows (…, template, figures: map, context: array) rendered and audited; see ``publishable`` there."""
    text = T.render(F.col("template"), F.col("figures"))
    used = F.transform(F.array_distinct(T.tokens_in(F.col("template"))), lambda t: F.element_at("figures", t))
    rows = sections.withColumn("rendered", text).withColumn("_used", used)
    audit = T.audit_digits(F.col("rendered"), F.col("_used"), F.col("context"), references)
    rows = rows.withColumn("_audit", audit).select("*", "_audit.*").drop("_used", "_audit")
    return rows.withColumn("publishable", F.size("invented") == 0)
