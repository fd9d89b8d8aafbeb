"""Small tables that a deployment states: institutions, sections, kinds of sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed: what the letters of a credit code stand for.
CATEGORY_NAMES = {"PRE": "Report Preface", "AC": "Academics", "EN": "Engagement", "OP": "Operations", "PA": "Planning & Administration", "IL": "Innovation & Leadership"}


@dataclass(frozen=True)
class Institution:
    """One reporting institution; paths are of its folder in a lake."""

    key: str
    name: str
    version: str = ""

    def path(self, root: str, name: str) -> str:
        return f"{root}/{self.key}/{name}"


def institutions(spark: SparkSession, known: list[Institution]) -> DataFrame:
    return spark.createDataFrame([(i.key, i.name, i.version) for i in known], "institution_key string, institution string, stars_version string")


def outline(spark: SparkSession, sections: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """(section, title, disclosure, ord) of a report's sections: key -> (title, disclosures)."""
    rows = [(k, title, d, n) for k, (title, found) in sections.items() for n, d in enumerate(found)]
    return spark.createDataFrame(rows, "section string, title string, disclosure string, ord int")


@dataclass(frozen=True)
class Note:
    """Why figures of an institution's credit, or of fields whose name has a part, can't be read at face value."""

    institution_key: str
    text: str
    credit: str | None = None
    part: str | None = None

    def holds(self) -> Column:
        test = F.col("institution_key") == self.institution_key
        test = test if self.credit is None else test & (F.col("credit") == self.credit)
        return test if self.part is None else test & F.contains(F.lower("field"), F.lit(self.part.lower()))


def looked_up(c: Column, table: dict[str, str], default: str) -> Column:
    """A value's counterpart in a literal map, such as a source's kind."""
    if not table:
        return F.lit(default)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c), F.lit(default))
