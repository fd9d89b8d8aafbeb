"""Typing and formatting of reported values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import fixed as X
from lodestone.functions.nulls import is_populated


def value_type(field: Column, value: Column, units: Column) -> Column:
    """not_reported, year, number, boolean, url, date, text_long or text; the first that holds."""
    year = F.coalesce(field.rlike(X.YEAR_FIELD), F.lit(False)) & ~is_populated(units) & value.rlike(X.YEAR)
    return (
        F.when(F.coalesce(value, F.lit("")) == "", "not_reported")
        .when(value.rlike(X.NUMERIC), F.when(year, "year").otherwise("number"))
        .when(F.lower(value).isin("yes", "no"), "boolean")
        .when(value.rlike("^https?://"), "url")
        .when(value.rlike(X.DATE), "date")
        .when(F.length(value) > X.LONG_TEXT, "text_long")
        .otherwise("text")
    )


def value_numeric(value: Column) -> Column:
    """The number of a numeric value, group separators aside; null for anything else."""
    return F.when(value.rlike(X.NUMERIC), F.regexp_replace(value, ",", "").try_cast("double"))


def score_pair(text: Column) -> tuple[Column, Column]:
    """Both numbers of "a / b"; null where one is missing."""
    part = lambda k: F.regexp_extract(text, r"^\s*(-?[0-9.]+)?\s*/\s*(-?[0-9.]+)?\s*$", k).try_cast("double")
    return part(1), part(2)


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, half-even; null where the whole is 0 or missing."""
    return F.bround(100 * part / F.nullif(whole, F.lit(0)), digits)


def split_units(value: Column, trailing: Column) -> tuple[Column, Column]:
    """A value and its unit: what trails a bare number is its unit, else part of the value.

    Marks for "not reported" become empty.
    """
    bare = value.rlike(X.NUMERIC)
    joined = F.trim(F.concat_ws(" ", value, trailing))
    return F.when(bare, value).when(joined.isin(*X.NOT_REPORTED), "").otherwise(joined), F.when(bare, F.coalesce(trailing, F.lit(""))).otherwise("")


def with_unit(label: Column, value: Column, units: Column) -> Column:
    """A value as it reads in prose: with its unit, a percent sign, or the unit its label counts."""
    counted = F.lower(F.regexp_extract(label, X.COUNTED_UNIT, 1))
    return (
        F.when(is_populated(units), F.concat_ws(" ", value, F.trim(units)))
        .when(label.rlike(r"(?i)\bpercentage\b|\bpercent\b"), F.concat(value, F.lit("%")))
        .when(counted != "", F.concat_ws(" ", value, counted))
        .otherwise(value)
    )


def cell(value: Column, units: Column) -> Column:
    """A value in a table cell: pipes escaped, long ones cut, or said to be missing."""
    safe = lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))
    text = F.trim(value)
    return (
        F.when(~is_populated(value), "not reported by the institution")
        .when(F.length(text) > X.CELL_CHARS + 3, F.concat(safe(F.substring(text, 1, X.CELL_CHARS)), F.lit("…")))
        .otherwise(safe(F.trim(F.concat_ws(" ", text, F.trim(units)))))
    )


def pillar(code: Column) -> Column:
    """The pillar of a credit code, by its letters and, for PA, its number."""
    letters, number = F.split_part(code, F.lit("-"), F.lit(1)), F.regexp_extract(code, "^[A-Z]+-([0-9]+)", 1).try_cast("int")
    return (
        F.when(letters == "PRE", "Preface")
        .when(letters.isin("AC", "EN"), "Context")
        .when(letters == "OP", "Environmental")
        .when((letters == "PA") & (number <= 5), "Governance")
        .when(letters == "PA", "Social")
        .when(letters == "IL", "Bonus")
        .otherwise("Unknown")
    )


def compound_key(number: Column) -> tuple[Column, Column]:
    """Sort keys of "305-1", numeric in both parts; malformed numbers come last."""
    first, second = F.split_part(number, F.lit("-"), F.lit(1)).try_cast("int"), F.split_part(number, F.lit("-"), F.lit(2)).try_cast("int")
    well = first.isNotNull() & second.isNotNull()
    return F.when(well, first).otherwise(9999), F.when(well, second).otherwise(0)


def position(c: Column, order: list[str]) -> Column:
    """Place of a value in a list, from 1; values outside come last."""
    at = F.array_position(F.array(*map(F.lit, order)), c)
    return F.when(F.coalesce(at, F.lit(0)) == 0, len(order) + 1).otherwise(at)
