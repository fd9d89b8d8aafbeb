"""Readers of delimited files, JSON, text corpora, cached pages and office documents."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain, count, islice
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import fixed as X
from lodestone.functions.nulls import missing_to_null
from lodestone.functions.sizes import dealt_out, sent_if_small
from lodestone.operators.chunking import strip
from lodestone.sources.pdf import pdf_text
from lodestone.sources.schemas import MANIFEST, REQUIREMENT, VOCABULARY


def with_ordinal(rows: DataFrame, out: str) -> DataFrame:
    """What was just read from files, with the place of each row among all: files by path, their splits by place, rows as they stand there.

    Within a split Spark's increasing ids are consecutive, so a row's place is its id less the split's first one, and the number of
    rows of all splits before. Only the table of splits, a row for each, is put in one order; no row is moved for it. The order
    is that of the files whatever tasks read them. Call it on the reader's result, before any filter.
    """
    found = rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).alias("_split"), F.monotonically_increasing_id().alias("_id"))
    splits = found.groupBy("_split").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = splits.select("_split", (before - F.col("_first")).alias("_base"))
    return found.join(sent_if_small(base), "_split").withColumn(out, F.col("_base") + F.col("_id")).drop("_split", "_id", "_base")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, ordinal: str | None = None) -> DataFrame:
    """A delimited file with a header, by a declared schema; marks of missing values read as null. ``ordinal``: a column of rows' places from 0, over all files.

    All columns are read as text first, so that a value such as "None" in a number's column is
    null and not an error, and so that no text is taken for a number. Names in the header
    must be those of the schema.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False, mode="FAILFAST")
    cast = lambda f: missing_to_null(f.name) if isinstance(f.dataType, T.StringType) else missing_to_null(f.name).try_cast(f.dataType)
    columns = [cast(f).alias(f.name) for f in schema.fields]
    return raw.select(*columns) if ordinal is None else with_ordinal(raw, ordinal).select(*columns, ordinal)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(standard, standard_title, family, disclosure, title) of a nested JSON vocabulary."""
    raw = spark.read.schema(VOCABULARY).json(path, multiLine=True)
    standards = raw.select(F.explode("standards").alias("standard", "body"))
    return standards.select("standard", F.col("body.title").alias("standard_title"), F.col("body.family").alias("family"), F.explode("body.disclosures").alias("disclosure", "title"))


def read_requirements(spark: SparkSession, path: str) -> DataFrame:
    """(number, title, standard, text, source_url, cached_source) of a JSON object by number, at the top or under ``requirements``;
    keys that don't state one are left out."""
    kind = T.MapType(T.StringType(), T.StringType())
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("m"))
    raw = raw.select(F.coalesce(F.from_json(F.element_at("m", "requirements"), kind), "m").alias("m"))
    rows = raw.select(F.explode("m").alias("number", "body")).withColumn("body", F.from_json("body", REQUIREMENT))
    return rows.where(F.col("body.title").isNotNull()).select("number", "body.*")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stem(c: Column) -> Column:
    """A file's name without folders and its last extension."""
    return F.regexp_replace(F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), ".*/", ""), r"\.[^.]*$", "")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(source, url, body) of text files with a short header above a rule of equal signs."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    head, body = F.substring_index("value", X.HEADER_RULE, 1), F.regexp_replace("value", f"(?s)^.*?{X.HEADER_RULE}", "")
    of = lambda name: F.trim(F.regexp_extract(head, rf"(?m)^{name}:(.*)$", 1))
    source = F.when(of("SOURCE") != "", of("SOURCE")).otherwise(stem(F.col("file")))
    return raw.select(source.alias("source"), of("URL").alias("url"), F.when(F.contains("value", F.lit(X.HEADER_RULE)), strip(body)).otherwise("").alias("body"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(key, html) of cached pages; the key is the file's stem."""
    return spark.read.text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("key"), F.col("value").alias("html"))


def read_manifest(spark: SparkSession, path: str, texts: str) -> DataFrame:
    """The rows of a manifest of documents with their extracted texts, files of the same stem; ``ord`` is their order in it, over all its files."""
    listed = read_csv(spark, path, MANIFEST, "ord")
    found = read_pages(spark, texts).select(F.col("key").alias("_stem"), F.col("html").alias("text"))
    return listed.join(found, F.regexp_replace("local_file", r"\.[^.]*$", "") == F.col("_stem")).drop("_stem")


def docx_text(raw: bytes) -> str:
    """The paragraphs of a word-processor document."""
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        tree = ElementTree.fromstring(z.read("word/document.xml"))
    lines = ("".join(t.text or "" for t in p.iter(f"{space}t")) for p in tree.iter(f"{space}p"))
    return "\n".join(x for x in lines if x.strip())


def xlsx_text(raw: bytes) -> str:
    """The rows of a workbook's sheets, cells joined by bars."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    lines = []
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{space}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{space}si")]
        for name in sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n))):
            for row in ElementTree.fromstring(z.read(name)).iter(f"{space}row"):
                cells = []
                for c in row.iter(f"{space}c"):
                    value = c.findtext(f"{space}v")
                    inline = "".join(t.text or "" for t in c.iter(f"{space}t"))
                    cells.append(shared[int(value)] if c.get("t") == "s" and value else value or inline)
                if any(x.strip() for x in cells):
                    lines.append(" | ".join(x for x in cells if x.strip()))
    return "\n".join(lines)


#: By extension; others are reported as unsupported. Add a function from bytes to text for more.
EXTRACTORS: dict[str, Callable[[bytes], str]] = {".pdf": pdf_text, ".docx": docx_text, ".xlsx": xlsx_text, ".xlsm": xlsx_text, ".csv": lambda raw: raw.decode("utf-8", "replace"), ".txt": lambda raw: raw.decode("utf-8", "replace")}


#: Documents of an archive, and bytes from which on a next one is begun. A reader has an archive in memory as a whole.
ARCHIVED, ARCHIVE_BYTES = 5_000, 32_000_000
BATCH = 1_000


def write_archives(documents: DataFrame, path: str, each: int = ARCHIVED) -> None:
    """Documents (name string, content binary) as members of zip archives in a folder, ``each`` a task, about.

    A file and a folder for each document would be written by one task where the table is small, moved and listed one by one by the
    driver. ``path`` is a local path or a URI of a store that Arrow knows (file, hdfs, s3, gs). ``extract_documents`` reads archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        fs.create_dir(root, recursive=True)
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        for nth in count():
            if (first := next(rows, None)) is None:
                return
            # what begins with _ is not there for readers; a task that is done again finds its archives, which hold the same
            fresh, name, size, n = f"{root}/_{uuid.uuid4().hex}", f"{root}/part-{TaskContext.get().partitionId():06d}-{nth:06d}.zip", 0, 0
            with fs.open_output_stream(fresh) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for member, content in chain([first], rows):
                    z.writestr(zipfile.ZipInfo(member), content or b"", zipfile.ZIP_DEFLATED)
                    size, n = size + len(content or b""), n + 1
                    if size >= ARCHIVE_BYTES:
                        break
            if fs.get_file_info(name).type == pafs.FileType.NotFound:
                fs.move(fresh, name)
            else:
                fs.delete_file(fresh)
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    dealt_out(documents.select("name", "content"), each).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()


def extract_documents(spark: SparkSession, path: str, extractors: dict[str, Callable[[bytes], str]] | None = None, least: int = 200, archives: bool = False) -> DataFrame:
    """(file, extension, text, status) of binary documents.

    status: ok, empty (fewer than ``least`` code points), unsupported, or failed with the error's name. Spark lists no
    file without any byte. ``archives``: a zip archive is as a folder of its members, those without any byte left out.
    """
    by = extractors or EXTRACTORS
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")

    def extracted(file: str, read: Callable[[], bytes]) -> tuple[str, str, str | None, str]:
        ext = (re.search(r"\.[^./]+$", file.lower()) or [""])[0]
        if ext not in by:
            return file, ext, None, "unsupported"
        try:
            text = by[ext](read())
            return file, ext, text, "ok" if len(text) >= least else "empty"
        except Exception as e:  # a broken file is a row's status, not the job's end
            return file, ext, None, f"failed: {type(e).__name__}"

    def within(file: str, content: bytes) -> Iterator[tuple[str, str, str | None, str]]:
        if not (archives and file.lower().endswith(".zip")):
            yield extracted(file, lambda: content)
            return
        try:
            members = zipfile.ZipFile(io.BytesIO(content))
        except Exception as e:
            yield file, ".zip", None, f"failed: {type(e).__name__}"
            return
        for m in members.infolist():
            if m.file_size:
                yield extracted(f"{file}/{m.filename}", partial(members.read, m))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (row for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in within(file, content))
            while some := list(islice(rows, BATCH)):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*some, strict=True)], names=["file", "extension", "text", "status"])

    return raw.mapInArrow(run, "file string, extension string, text string, status string")
