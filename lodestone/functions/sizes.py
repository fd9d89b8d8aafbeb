"""Broadcasts behind a check of size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a table of a few short columns is sent to all executors: some tens of MB.
SENT_ROWS = 1_000_000


def sent_if_small(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """A table, to be broadcast in a join if a count finds at most ``rows`` rows; else Spark shuffles it.

    The count reads the table's first rows only; give it one that is cheap to read.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def dealt_out(df: DataFrame, rows: int) -> DataFrame:
    """The rows in tasks of about ``rows``: costly work on short rows, which a few small files hold, would else be that of a few tasks."""
    return df.repartition(max(1, -(-df.count() // rows)))


def dealt_by_key(df: DataFrame, key: str, size: Column, most: int) -> DataFrame:
    """The rows dealt out by a key to the session's number of partitions, or to more, where the sum of their sizes asks for it: about ``most`` each.

    Windows by that key over what the rows are made into stay in these tasks. In the session's number alone, what a task sorts
    would grow with the table. A null size counts as none.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(-(-total // most), key) if total > most * least else df.repartition(key)
