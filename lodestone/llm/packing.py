"""Best-two-fit packing of tokenised documents into sequences of one length."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm.bpe import LATIN_DIGITS, LATIN_LETTERS, LATIN_WHITE, WHITE, byte_alphabet, is_latin
from lodestone.llm.common import in_arrow, text_slices
from lodestone.sources.tables import table

LENGTH = 2048
SEPARATOR = 0
#: Documents that one task packs together. A task's rest, its last sequences, is lost for others: less than one sequence in a thousand.
DOCS_AT_ONCE = 20_000
#: Words whose ids a worker keeps; beyond this number it starts anew.
WORDS_KEPT = 400_000


#: Plain new words that the library gets in one text, and the character that stands for a space in its tokens.
TOGETHER, SPACE = 200, byte_alphabet()[32]


def words_pattern(white: str, letters: str, digits: str) -> str:
    """The byte-level pre-tokenizer's fixed pattern, from the contents of three character classes."""
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{white}{letters}{digits}]+|[{white}]+(?![^{white}])|[{white}]+"


class Places(dict):
    """Numbers words in the order in which they are first asked for; ``new`` has those since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = k = len(self)
        return k


class CachedTokenizer:
    """Ids by the ``tokenizers`` library, which is asked once for each word that a worker meets.

    A byte-level pre-tokenizer's words are encoded independently of each other, so a text's ids
    are its words' ids in order. Texts with a special token's string go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = regex.compile(words_pattern(WHITE, r"\p{L}", r"\p{N}"))
        self.latin_words = re.compile(words_pattern(LATIN_WHITE, LATIN_LETTERS, LATIN_DIGITS))
        self.plain = re.compile(f" [{LATIN_LETTERS}]+").fullmatch
        #: by id, whether the token begins with a space; of a plain word only the first one does
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[k for name, k in self.tokenizer.get_vocab().items() if name.startswith(SPACE)]] = True
        self.clear()

    def clear(self) -> None:
        self.places = Places()
        self.begin, self.count, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)
        self.used = 0

    def split(self, text: str) -> list[str]:
        return (self.latin_words if is_latin(text) else self.words).findall(text)

    def learn(self) -> None:
        """Ask the library for the new words: plain ones in long texts, which it splits again, others alone."""
        new, self.places.new = self.places.new, []
        last = len(self.places)
        first = last - len(new)
        for name in ("begin", "count"):
            if len(old := getattr(self, name)) < last:
                setattr(self, name, np.concatenate([old, np.zeros(last, old.dtype)]))
        plain = [k for k, w in enumerate(new) if self.plain(w)]
        alone = sorted(set(range(len(new))).difference(plain))
        for a in range(0, len(plain), TOGETHER):
            part = plain[a : a + TOGETHER]
            sizes, ids = self.together([new[k] for k in part])
            if len(sizes) != len(part):
                raise ValueError("the tokenizer does not split at spaces")
            self.keep(np.array(part) + first, sizes, ids)
        if alone:
            ids = [e.ids for e in self.tokenizer.encode_batch([new[k] for k in alone], add_special_tokens=False)]
            self.keep(np.array(alone) + first, np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.int64))

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each of some plain words, which begin with a space, and all their ids."""
        (got,) = self.tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)
        ids = np.array(got.ids, np.int64)
        (first,) = np.nonzero(self.spaced[ids])
        return np.diff(first, append=len(ids)), ids

    def keep(self, places: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        if len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(ids), np.uint32)])
        self.count[places] = sizes
        self.begin[places] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit numbers."""
        if len(self.places) > WORDS_KEPT:
            self.clear()
        whole = {k: t for k, t in enumerate(texts) if any(s in t for s in self.special)}
        lists = [[] if k in whole else self.split(t) for k, t in enumerate(texts)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(self.places.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
        if self.places.new:
            self.learn()
        counts = self.count[at]
        upto = np.cumsum(counts)
        ids = self.flat[np.repeat(self.begin[at] - (upto - counts), counts) + np.arange(upto[-1] if len(upto) else 0)]
        ends = np.concatenate(([0], upto))[np.cumsum(sizes)]
        begin = 0
        for k, end in enumerate(ends.tolist()):
            if k in whole:
                yield np.array(self.tokenizer.encode(whole[k], add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[begin:end]
            begin = end


_loaded: dict[str, CachedTokenizer] = {}


def loaded(path: str) -> CachedTokenizer:
    if path not in _loaded:
        _loaded[path] = CachedTokenizer(path)
    return _loaded[path]


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, size) of the pieces of a document of n ids: full ones, after a shorter first."""
    if n <= length:
        return [(0, n)]
    edges = [0, *range(n % length or length, n + 1, length)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def best_two_fit(sizes: list[int], length: int = LENGTH) -> tuple[list[int], list[int], int]:
    """A bin and an offset for each item, and the number of bins.

    A bin is filled greedily with the largest items that fit. Then, while there is a gap, its
    smallest item goes back if two unpacked ones can take its place and fill the gap, widened by
    it, more tightly; of all such pairs the one with the largest sum.
    """
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    for k in range(len(sizes) - 1, -1, -1):
        stacks[sizes[k]].append(k)
    # bit n of have, and bit length - n of back: some item of size n is unpacked
    have = back = 0
    for n in range(1, length + 1):
        if stacks[n]:
            have |= 1 << n
            back |= 1 << (length - n)
    of_bin, offset = [0] * len(sizes), [0] * len(sizes)
    bins = 0

    def take(n: int) -> int:
        nonlocal have, back
        k = stacks[n].pop()
        if not stacks[n]:
            have &= ~(1 << n)
            back &= ~(1 << (length - n))
        return k

    def largest(most: int) -> int:
        return (have & ((1 << (most + 1)) - 1)).bit_length() - 1

    while have:
        inside: list[int] = []
        gap = length
        while gap and (n := largest(gap)) > 0:
            inside.append(take(n))
            gap -= n
        while gap and have:
            least = min(inside, key=sizes.__getitem__)
            room = gap + sizes[least]
            for total in range(room, sizes[least], -1):
                both = have & (back >> (length - total))
                if total % 2 == 0 and both >> (total // 2) & 1 and len(stacks[total // 2]) < 2:
                    both &= ~(1 << (total // 2))
                if both:
                    a = both.bit_length() - 1
                    break
            else:
                break
            inside.remove(least)
            inside += [take(a), take(total - a)]
            n = sizes[least]
            stacks[n].append(least)
            have |= 1 << n
            back |= 1 << (length - n)
            gap = room - total
        at = 0
        for k in inside:
            of_bin[k], offset[k] = bins, at
            at += sizes[k]
        bins += 1
    return of_bin, offset, bins


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """A row for each piece of each document: id, piece, start, length, ids_crc32 and ids.

    The ids (little-endian unsigned 32-bit, as binary) end with the separator. Null text counts as
    empty and gives the separator alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(path)
        end = np.array([SEPARATOR], np.uint32)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                rows, numbers, parts = [], [], []
                for k, ids in enumerate(own.encode(texts)):
                    ids = np.concatenate((ids, end))
                    for piece, (a, n) in enumerate(cut(len(ids), length)):
                        raw = ids[a : a + n].tobytes()
                        rows.append(first + k)
                        numbers.append((piece, a, n, zlib.crc32(raw)))
                        parts.append(raw)
                columns = zip(*numbers, strict=True) if numbers else ((), (), (), ())
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrays, pa.array(parts, pa.binary())], names=[id_col, "piece", "start", "length", "ids_crc32", "ids"])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


def pack(pieces: DataFrame, n_docs: int, length: int = LENGTH, docs_at_once: int = DOCS_AT_ONCE) -> DataFrame:
    """The pieces (rows with a column ``length``, none longer than ``length``) with sequence_id and offset.

    Pieces are dealt by a hash of the whole row to groups of about ``docs_at_once`` documents, each
    of which a task packs; full pieces fill a sequence alone. Groups are independent, so a lost
    task is done again alone, and no task's memory grows with the input.
    """
    groups = max(1, -(-n_docs // docs_at_once))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(*pieces.columns), F.lit(groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(group: pa.Table) -> pa.Table:
        first = (group.column("_group")[0].as_py() if group.num_rows else 0) << 32
        of_bin, offset, _ = best_two_fit(group.column("length").to_pylist(), length)
        own = group.drop_columns(["_group"])
        return own.append_column("sequence_id", pa.array(np.array(of_bin, np.int64) + first)).append_column("offset", pa.array(offset, pa.int64()))

    return dealt.groupBy("_group").applyInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id and offset of each piece of each document.

    Repeated rows are packed each on its own; an empty table gives no row.
    """
    pieces = tokenised(docs, path, id_col, text_col, length).drop("ids")
    return pack(pieces, docs.count(), length)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 2048 tokens; as of ``pack_documents``.

    Null and empty texts have one piece, of the closing id 0 alone.
    """
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
