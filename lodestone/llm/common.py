"""What the operators of this subpackage share: folds, text batches and numpy views of text."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.stages import written

#: Code points that numpy works on at once; bounds the temporary arrays of a worker.
CHARS_AT_ONCE = 1_000_000
#: Rows that cross between Spark and Python at once.
ROWS_AT_ONCE = 1_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")), F.lit(n))


def slices(sizes: Iterable[int], most: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of items whose sizes add up to about ``most``; an item above that is alone."""
    begin = total = k = 0
    for k, n in enumerate(sizes, 1):
        if total and total + n > most:
            yield begin, k - 1
            begin, total = k - 1, 0
        total += n
    if k > begin:
        yield begin, k


def text_slices(column: pa.Array, most: int = CHARS_AT_ONCE) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) over a string column; null reads as empty."""
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(sizes.tolist(), most):
        yield a, [t or "" for t in column.slice(a, b - a).to_pylist()]


def in_arrow(df: DataFrame, run: Callable, schema: object) -> DataFrame:
    """``df.mapInArrow``, in batches of at most ``ROWS_AT_ONCE`` rows.

    Spark's default of 10,000 rows is meant for short rows; of whole texts such a batch has no useful
    bound. Spark reads the setting when the plan runs, so it is lowered for the session, but only
    where nobody has set it: a number that a deployment or a caller chose stays, 10,000 too.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in conf.getAll:
        conf.set(key, str(ROWS_AT_ONCE))
    return df.mapInArrow(run, schema)


def code_points(text: str) -> np.ndarray:
    """The text's code points as uint32."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_table() -> np.ndarray:
    """For each code point, whether it is a letter or digit; built once in a worker."""
    global _words
    if _words is None:
        _words = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _words


_words: np.ndarray | None = None
#: Items up to which a span is hashed two at a time beside others; longer spans are digested one by one.
SHORT = 128


def span_hashes(units: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span units[begin:end] of an array of code points (uint32) or bytes (uint8).

    A span's items are taken eight bytes at a time, each scrambled into the hash before the next, so
    that no arithmetic on repeated patterns cancels out, as it does in polynomials modulo 2**64. What
    lies around a span has no say.
    """
    size = units.itemsize
    per = 8 // size
    raw = np.concatenate((units.view(np.uint8), np.zeros(8, np.uint8)))
    eights = np.ndarray((len(units),), np.uint64, raw, strides=(size,))
    length = end - begin
    out = mixed(length.astype(np.uint64) * MIX)
    at = np.flatnonzero((length > 0) & (length <= SHORT))
    k = 0
    while len(at):
        left = length[at] - k
        taken = eights[begin[at] + k]
        short = left < per
        if short.any():
            taken[short] &= (np.uint64(1) << (left[short] * (8 * size)).astype(np.uint64)) - np.uint64(1)
        out[at] = mixed(out[at] ^ taken) + MIX
        at = at[left > per]
        k += per
    for i in np.flatnonzero(length > SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(units[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def word_hashes(texts: list[str], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and the number of words of each text.

    A word is a maximal run of code points that ``is_word`` marks; words never cross texts. Texts are
    worked on in slices, so that what this takes beside its result is bounded, but for a text that
    is longer than a slice.
    """
    parts = [_word_hashes(texts[a:b], is_word) for a, b in slices(map(len, texts))]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([h for h, _ in parts]), np.concatenate([n for _, n in parts])


def _word_hashes(texts: list[str], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = code_points("\n".join(texts) + "\n")
    inside = is_word[codes]
    # texts are joined by a line feed, which no table marks as a word
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate(([0], edges))
    begin, end = edges[0::2], edges[1::2]
    hashes = span_hashes(codes, begin, end)
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    upto = np.searchsorted(begin, stops)
    return hashes, np.diff(upto, prepend=0)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, read back from the shared folder (``stages.written``); cuts the lineage.

    What led to the rows needs its shuffle files no more; the driver's garbage is collected so that
    Spark's cleaner can drop them.
    """
    spark = df.sparkSession
    out = written(df)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out
