"""Writers: tables, JSON lines, Markdown, and writes that happen whole or not at all."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """For people and spreadsheets: arrays are joined by spaces, null is empty."""
    flat = [F.concat_ws(" ", c).alias(c) if kind.startswith("array<") else F.col(c) for c, kind in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_requirements(df: DataFrame, path: str, preamble: Sequence[str], retrieved: str) -> None:
    """One JSON document: a preamble, when it was retrieved, and the rows by ``number``. A vocabulary's, so they are few."""
    body = F.struct(*[c for c in df.columns if c != "number"])
    by = F.map_from_entries(F.array_sort(F.collect_list(F.struct("number", body.alias("body"))))).alias("requirements")
    whole = df.agg(F.to_json(F.struct(F.array(*map(F.lit, preamble)).alias("_README"), F.lit(retrieved).alias("retrieved"), by)).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(path)


def write_index(df: DataFrame, path: str) -> None:
    """A vector index: the vector beside its metadata in each row, a folder for each lane."""
    df.write.mode("overwrite").partitionBy("lane").parquet(path)


def markdown_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.replace(c.cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in cells]), F.lit(" |"))


def markdown_tables(df: DataFrame, group: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """A Markdown table for each group, rows in order. A group is one table of a report, and fits a page."""
    head = f"| {' | '.join(columns)} |\n|{'---|' * len(columns)}\n"
    rows = F.array_sort(F.collect_list(F.struct(*order, markdown_row(*map(F.col, columns)).alias("_row"))))
    return df.groupBy(*group).agg(F.concat(F.lit(head), F.array_join(F.transform(rows, lambda r: r["_row"]), "\n")).alias("markdown"))


def assembled(parts: Column, front: Column, skip: int = 4) -> Column:
    """A report of parts: front matter, then each part without its first lines."""
    bodies = F.transform(parts, lambda p: F.array_join(F.slice(F.split(p, "\n"), skip + 1, 1_000_000), "\n"))
    return F.concat_ws("\n\n", front, F.array_join(bodies, "\n\n"))


class Incomplete(RuntimeError):
    """A set that may not be published."""


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, Callable[..., JavaObject]]:
    """Hadoop's file system of a path, and its constructor of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


#: Folders of a published set: one for each version of its rows, and the log of commits, of which the last counts.
VERSIONS, COMMITS = "versions", "_commits"


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the commits of a published set, in order. A commit's file that isn't whole, as after a crash, isn't one."""
    fs, make = file_system(spark, path)
    if not fs.exists(make(f"{path}/{COMMITS}")):
        return []
    out = []
    for status in fs.listStatus(make(f"{path}/{COMMITS}")):
        name = status.getPath().getName()
        if re.fullmatch(r"[0-9]{12}", name):
            stream = fs.open(status.getPath())
            try:
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if whole := re.fullmatch(r"([0-9a-f]{32})\n", text):
                out.append((int(name), whole[1]))
    return sorted(out)


def commit(spark: SparkSession, path: str, version: str) -> int:
    """Make a version of a set, all of whose files are written, the one that readers get: one small file, which nobody overwrites.

    Its number is the next one; where another writer has taken that meanwhile, the one after it.
    """
    fs, make = file_system(spark, path)
    fs.mkdirs(make(f"{path}/{COMMITS}"))
    taken = [int(s.getPath().getName()) for s in fs.listStatus(make(f"{path}/{COMMITS}")) if re.fullmatch(r"[0-9]{12}", s.getPath().getName())]
    number = max(taken, default=-1) + 1
    while True:
        try:
            stream = fs.create(make(f"{path}/{COMMITS}/{number:012d}"), False)
        except Py4JJavaError:
            if not fs.exists(make(f"{path}/{COMMITS}/{number:012d}")):
                raise
            number += 1
            continue
        try:
            stream.write(bytearray(f"{version}\n".encode()))
        finally:
            stream.close()
        return number


def retire(spark: SparkSession, path: str, keep: int) -> None:
    """Remove the versions of all but the last ``keep`` commits, then those commits. What an open reader may still read should be among those kept."""
    fs, make = file_system(spark, path)
    known = commits(spark, path)
    kept = {v for _, v in known[-keep:]}
    for number, version in known[:-keep]:
        if version not in kept:
            fs.delete(make(f"{path}/{VERSIONS}/{version}"), True)
        fs.delete(make(f"{path}/{COMMITS}/{number:012d}"), False)


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of the last commit of a published set, or of one by its number; a folder without commits is read as plain Parquet."""
    known = commits(spark, path)
    if number is not None:
        return spark.read.parquet(f"{path}/{VERSIONS}/{dict(known)[number]}")
    return spark.read.parquet(f"{path}/{VERSIONS}/{known[-1][1]}" if known else path)


def guarded_write(df: DataFrame, path: str, checks: dict[str, Callable[[DataFrame], bool]], preview: str | None = None, keep: int = 2) -> str:
    """Publish the rows at ``path`` only if all checks hold for what was written.

    The rows are written as a version beside those that are there, read back and checked; then a commit names the
    version. Until that one file is whole readers (``read_published``) get the version before, and nothing of it is touched: a failure
    at any moment loses nothing. If a check fails, nothing is committed; with ``preview`` the version is moved there and
    committed there instead. The last ``keep`` versions stay. Returns where the rows are published.
    """
    spark = df.sparkSession
    fs, make = file_system(spark, path)
    version = uuid.uuid4().hex
    staged = f"{path}/{VERSIONS}/{version}"
    df.write.mode("errorifexists").parquet(staged)
    written = spark.read.parquet(staged)
    failed = [name for name, check in checks.items() if not check(written)]
    if failed:
        if preview:
            fs.mkdirs(make(f"{preview}/{VERSIONS}"))
            if not fs.rename(make(staged), make(f"{preview}/{VERSIONS}/{version}")):
                raise OSError(f"{staged} could not be moved to {preview}")
        else:
            fs.delete(make(staged), True)
        for emptied in (f"{path}/{VERSIONS}", path):  # folders that this write alone has made
            if fs.exists(make(emptied)) and not len(fs.listStatus(make(emptied))):
                fs.delete(make(emptied), False)
        if not preview:
            raise Incomplete(", ".join(failed))
    goal = preview if failed else path
    commit(spark, goal, version)
    retire(spark, goal, keep)
    return goal
