"""Token ids as flat binary files with 64-bit document offsets, written and memory-mapped by a data source."""

from __future__ import annotations

import json
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from lodestone.functions.stages import shared_folder, written
from lodestone.llm.bpe import LATIN_LETTERS, WordBpe
from lodestone.llm.common import in_arrow, slices, text_slices
from lodestone.llm.packing import CachedTokenizer
from lodestone.sources.tables import table

#: The list of a folder's parts; written last, so that a folder without it, or what it doesn't name, isn't there.
INDEX = "index.json"
#: Ids that one task reads, and that one batch holds, about; a document is never cut.
SPLIT_IDS, BATCH_IDS = 64_000_000, 4_000_000
END = 2


def place_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path on it: a local path, or a URI of a store that Arrow knows (file, hdfs, s3, gs, ...)."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def index_of(path: str) -> dict:
    """What a folder's index says: the width of an id, the type of documents' ids, and its parts in order with their prefix sums."""
    fs, root = place_of(path)
    if fs.get_file_info(f"{root}/{INDEX}").type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"{path} has no {INDEX}: nothing was committed there")
    with fs.open_input_file(f"{root}/{INDEX}") as f:
        return json.loads(f.read())


def numbers(fs: pafs.FileSystem, path: str, kind: str, begin: int, end: int) -> np.ndarray:
    """Numbers begin to end of a flat file: a memory map of it, or that range alone where the store isn't this machine's."""
    size = np.dtype(kind).itemsize
    if end <= begin:
        return np.zeros(0, kind)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r", offset=begin * size, shape=(end - begin,))
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_at((end - begin) * size, begin * size), kind)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each row of a binary column, none of null, and all ids in one array."""
    column = pc.fill_null(column, b"").cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or edges[-1] == edges[0]:
        return np.zeros(len(column), np.int64), np.zeros(0, "<u4")
    return np.diff(edges) // 4, np.frombuffer(column.buffers()[2], "<u4", (edges[-1] - edges[0]) // 4, edges[0])


@dataclass
class Part(WriterCommitMessage):
    """What one task has written."""

    nth: int
    name: str
    docs: int
    ids: int


class TokenWriter(DataSourceArrowWriter):
    """Writes each task's rows to files of their own, and on commit the index that names them."""

    def __init__(self, path: str, width: int, schema: StructType, overwrite: bool):
        kinds = {f.name: f.dataType for f in schema.fields}
        if set(kinds) != {"doc_id", "ids"} or kinds["ids"].simpleString() != "binary":
            raise ValueError("token files are written from the columns doc_id and ids (binary: little-endian unsigned 32-bit ids)")
        self.path, self.width, self.overwrite = path, width, overwrite
        self.id_kind = kinds["doc_id"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, root = place_of(self.path)
        fs.create_dir(root, recursive=True)
        nth = TaskContext.get().partitionId()
        name = f"part-{nth:06d}-{uuid.uuid4().hex}"
        docs, at, most = 0, 0, 2 ** (8 * self.width) - 1
        with fs.open_output_stream(f"{root}/{name}.ids") as ids, fs.open_output_stream(f"{root}/{name}.offsets") as offsets, fs.open_output_stream(f"{root}/{name}.docs") as own:
            offsets.write(np.zeros(1, "<i8").tobytes())
            with pa.ipc.new_file(own, pa.schema([("doc_id", to_arrow_type(self.id_kind))])) as keys:
                for batch in iterator:
                    sizes, values = flat(batch.column(batch.schema.get_field_index("ids")))
                    if len(values) and int(values.max()) > most:
                        raise ValueError(f"id {values.max()} needs more than {self.width} bytes")
                    ids.write(values.astype(f"<u{self.width}").tobytes())
                    offsets.write((at + np.cumsum(sizes)).astype("<i8").tobytes())
                    keys.write_batch(pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")).cast(to_arrow_type(self.id_kind))], names=["doc_id"]))
                    docs += len(batch)
                    at += int(sizes.sum())
        return Part(nth, name, docs, at)

    def commit(self, messages: list[Part | None]) -> None:
        """Name the parts, in the order of the tasks. Where a part begins is the sum of those before it."""
        fs, root = place_of(self.path)
        fs.create_dir(root, recursive=True)
        exists = fs.get_file_info(f"{root}/{INDEX}").type != pafs.FileType.NotFound
        old = index_of(self.path) if exists else None
        if old and not self.overwrite and (old["width"], old["id_kind"]) != (self.width, self.id_kind.simpleString()):
            raise ValueError(f"{self.path} has ids of {old['width']} bytes and documents' ids of type {old['id_kind']}")
        parts = old["parts"] if old and not self.overwrite else []
        docs, ids = (parts[-1]["first_doc"] + parts[-1]["docs"], parts[-1]["base"] + parts[-1]["ids"]) if parts else (0, 0)
        for m in sorted(filter(None, messages), key=lambda m: m.nth):
            parts.append({"name": m.name, "docs": m.docs, "ids": m.ids, "first_doc": docs, "base": ids})
            docs, ids = docs + m.docs, ids + m.ids
        index = {"width": self.width, "id_kind": self.id_kind.simpleString(), "parts": parts}
        fresh = f"{root}/{INDEX}-{uuid.uuid4().hex}"
        with fs.open_output_stream(fresh) as f:
            f.write(json.dumps(index).encode())
        fs.move(fresh, f"{root}/{INDEX}")
        if old and self.overwrite:
            self.remove(fs, root, [p["name"] for p in old["parts"]])

    def abort(self, messages: list[Part | None]) -> None:
        """The index stays as it was, so nothing of this write is there; its files go."""
        self.remove(*place_of(self.path), [m.name for m in filter(None, messages)])

    @staticmethod
    def remove(fs: pafs.FileSystem, root: str, names: list[str]) -> None:
        for name in names:
            for kind in ("ids", "offsets", "docs"):
                if fs.get_file_info(f"{root}/{name}.{kind}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{root}/{name}.{kind}")


@dataclass
class Stretch(InputPartition):
    """Some documents of a part, by number."""

    name: str
    base: int
    begin: int
    end: int


class TokenReader(DataSourceReader):
    """Rows of the documents: doc_id, start (ids of all documents before it), n_tokens, ids."""

    def __init__(self, path: str, split: int):
        self.path, self.split = path, split
        self.index = index_of(path)

    def partitions(self) -> Sequence[Stretch]:
        out = []
        for p in self.index["parts"]:
            pieces = min(max(1, -(-p["ids"] // self.split)), max(1, p["docs"]))
            edges = [p["docs"] * k // pieces for k in range(pieces + 1)]
            out += [Stretch(p["name"], p["base"], a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        return out or [Stretch("", 0, 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        fs, root = place_of(self.path)
        a, b = partition.begin, partition.end
        if b <= a:
            return
        offsets = np.asarray(numbers(fs, f"{root}/{partition.name}.offsets", "<i8", a, b + 1))
        own = pa.memory_map(f"{root}/{partition.name}.docs") if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(f"{root}/{partition.name}.docs")
        with own:
            keys = pa.ipc.open_file(own).read_all().column(0)
            for x, y in slices(np.diff(offsets).tolist(), BATCH_IDS):
                ids = np.asarray(numbers(fs, f"{root}/{partition.name}.ids", f"<u{self.index['width']}", int(offsets[x]), int(offsets[y]))).astype("<u4")
                start = offsets[x : y + 1]
                raw = pa.Array.from_buffers(pa.binary(), y - x, [None, pa.py_buffer((4 * (start - start[0])).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([keys.slice(a + x, y - x).combine_chunks(), pa.array(partition.base + start[:-1]), pa.array(np.diff(start)), raw], names=["doc_id", "start", "n_tokens", "ids"])


class TokenFiles(DataSource):
    """``token_files``: a folder of flat unsigned ids, 64-bit offsets and documents' ids, part by part.

    Options: ``path``; ``width``, bytes of an id in the files (2 or 4; 4 if not given); ``split``, ids that one
    task reads. Each part has three files: ``.ids``, little-endian unsigned numbers without any header;
    ``.offsets``, n + 1 little-endian signed 64-bit places in it; ``.docs``, the documents' ids as an Arrow file. The
    index has the parts in order with their prefix sums, ``first_doc`` and ``base``, and is replaced in one step when
    all tasks are done: a task that runs twice, or a write that fails, leaves nothing that is read.
    """

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return f"doc_id {index_of(self.options['path'])['id_kind']}, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema: StructType) -> TokenReader:
        return TokenReader(self.options["path"], int(self.options.get("split", SPLIT_IDS)))

    def writer(self, schema: StructType, overwrite: bool) -> TokenWriter:
        width = int(self.options.get("width", 4))
        if width not in (2, 4):
            raise ValueError("width is 2 or 4")
        return TokenWriter(self.options["path"], width, schema, overwrite)


class Tokens(Sequence):
    """A committed folder as a sequence of documents' ids, for a training loader: ``Tokens(path)[k]`` is a memory map's slice."""

    def __init__(self, path: str):
        self.fs, self.root = place_of(path)
        index = index_of(path)
        self.kind, self.parts = f"<u{index['width']}", [p for p in index["parts"] if p["docs"]]
        self.first = [p["first_doc"] for p in self.parts]

    def __len__(self) -> int:
        return self.parts[-1]["first_doc"] + self.parts[-1]["docs"] if self.parts else 0

    def __getitem__(self, k: int) -> np.ndarray:
        if not 0 <= k < len(self):
            raise IndexError(k)
        part = self.parts[bisect_right(self.first, k) - 1]
        k -= part["first_doc"]
        begin, end = numbers(self.fs, f"{self.root}/{part['name']}.offsets", "<i8", k, k + 2).tolist()
        return numbers(self.fs, f"{self.root}/{part['name']}.ids", self.kind, begin, end)


class WordTokenizer(CachedTokenizer):
    """Ids by the ``tokenizers`` library for a file of lower-case words with word ends (``bpe.WordBpe``).

    Words are encoded independently of each other; the library gets each one once, and texts with a special token's string whole.
    """

    #: Characters of the words that a worker keeps; a longer text's words are let go with the rest.
    CHARS_KEPT = 4_000_000

    def __init__(self, path: str):
        super().__init__(path)
        self.by_file = WordBpe(path)
        self.plain = re.compile(f"[{LATIN_LETTERS}]+").fullmatch
        #: by id, whether the token ends a word
        self.ended = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ended[[k for name, k in self.tokenizer.get_vocab().items() if name.endswith(self.by_file.table.suffix)]] = True
        self.chars = 0

    def split(self, text: str) -> list[str]:
        return self.by_file.plain(text)

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        (got,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        return np.diff(np.flatnonzero(self.ended[ids]), prepend=-1), ids

    def learn(self) -> None:
        self.chars += sum(map(len, self.places.new))
        super().learn()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if getattr(self, "chars", 0) > self.CHARS_KEPT:
            self.clear()
            self.chars = 0
        return super().encode(texts)


_loaded: dict[str, WordTokenizer] = {}


def loaded(path: str) -> WordTokenizer:
    """The tokenizer, read once in a worker."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def encoded(docs: DataFrame, tokenizer: str, end: int | None = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit), ``end`` after each document's own; null text reads as empty."""
    kind = docs.schema[id_col].dataType.simpleString()
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(tokenizer)
        for batch in batches:
            for a, texts in text_slices(batch.column(1)):
                ids = [x.astype("<u4").tobytes() + tail for x in words.encode(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(ids)), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), run, f"doc_id {kind}, ids binary")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int | None = END, width: int = 2, id_col: str = "doc_id", text_col: str = "text", mode: str = "overwrite") -> None:
    """Encode documents and write them to a folder of ``token_files`` in ascending order of id, nulls first.

    Texts are dealt out by ranges of id, once; rows of one id are in order of a hash of their texts, and a hot id, even
    with equal texts, falls into several ranges. Each range is encoded as it is written, so no text is encoded twice.
    ``width`` bytes have to hold the largest id (an error says so). Rows may have other columns of any name.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumns({"_h": F.xxhash64("text"), "_nth": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange("doc_id", "_h", "_nth").sortWithinPartitions("doc_id", "_h", "_nth")
    encoded(dealt, tokenizer, end).write.format("token_files").option("path", path).option("width", str(width)).mode(mode).save()


def read_token_files(spark: SparkSession, path: str, split: int = SPLIT_IDS) -> DataFrame:
    """doc_id, start, n_tokens, ids of all documents of a folder: start counts the ids of all documents before it."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").option("path", path).option("split", str(split)).load()


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and size in token files of all documents, and a checksum of its ids, as read back from them.

    doc_id, start, n_tokens, ids_crc32. Null and empty texts have the end id alone; repeated rows are
    written as often as they are there; an empty table makes a folder without documents. The files go
    when they are read: what is returned has been written to the shared folder.
    """
    import public_tokenizers

    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    try:
        write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
        files = read_token_files(spark, path)
        return written(files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))
    finally:
        fs, root = place_of(path)
        if fs.get_file_info(root).type != pafs.FileType.NotFound:
            fs.delete_dir(root)
