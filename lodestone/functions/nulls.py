"""One meaning for missing: null, blank, or the mark for a whole record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.fixed import MISSING_TOKENS


def is_blank(c: Column | str, whole: str = "*") -> Column:
    """Null, white space alone, or the mark ``*``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | F.trim(c).isin("", whole)


def is_populated(c: Column | str) -> Column:
    """Neither null nor white space alone."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (F.trim(c) != "")


def missing_to_null(c: Column | str) -> Column:
    """Null for the tokens that delimited files use for it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.isin(*MISSING_TOKENS), c)


def not_in(c: Column | str, *values: object) -> Column:
    """True for null too, unlike SQL's NOT IN."""
    c = F.col(c) if isinstance(c, str) else c
    return ~F.coalesce(c.isin(*values), F.lit(False))


def row_key(*columns: str) -> Column:
    """A key of trimmed parts, null as empty."""
    return F.concat_ws("\x1f", *[F.coalesce(F.trim(c), F.lit("")) for c in columns])
