"""Declared shapes of the disclosure tables; nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, L = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in columns.items()])


SCORES = struct(institution=S, category=S, category_code=S, credit_code=S, credit_name=S, status=S, score=D, max=D)
COMBINED = struct(institution=S, stars_version=S, pillar=S, category=S, category_code=S, credit_code=S, credit_name=S, status=S, score=D, max=D)
FIELDS = struct(
    institution=S, credit_code=S, category=S, pillar=S, credit_name=S, indicator=S, section=S, field=S, value=S, units=S,
    value_numeric=D, value_type=S, links=S,
)
MAPPING = struct(
    stars_credit=S, stars_field=S, gri_standard=S, gri_disclosure=S, relationship=S, confidence=S, review_status=S, rationale=S,
    caveat=S, claude_verdict=S, claude_note=S, reviewed_by=S, reviewed_date=S,
)
CHUNK = struct(
    id=S, text=S, lane=S, institution=S, institution_key=S, source=S, url=S, source_type=S, language=S, scraper_flags=S,
    credit_code=S, credit_name=S, pillar=S, section=S, field=S, has_quantity=B, chunk_index=L, chars=L, words=L,
)
MANIFEST = struct(url=S, institution=S, credit_code=S, field=S, original_name=S, local_file=S, bytes=L, status=S, note=S, extract_status=S, text_chars=L)
VOCABULARY = struct(standards=T.MapType(S, struct(title=S, family=S, source_url=S, disclosures=T.MapType(S, S))))
REQUIREMENT = struct(title=S, standard=S, text=S, source_url=S, cached_source=S)
