"""Stupid-backoff language-model scores from n-gram counts of the corpus itself."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import checkpointed, mixed, word_hashes
from lodestone.sources.tables import table

ORDER = 3
BACKOFF = 0.4
#: An n-gram counts as seen from this count on; once is the document itself.
SEEN = 2
#: Code points of the texts that one task holds (more send fewer repeats of an n-gram, and take more memory), and n-grams that meet in one group of the count table; about.
CHUNK_CHARS, PART_GRAMS = 12_000_000, 1_500_000
#: Chunks whose n-grams meet at once; of more, groups of them are added up first, level by level.
FAN = 256
BLOCKS = "_part long, _of long, _grams binary, _counts binary"
TOTALS = "_part long, _of long, _totals binary"
_words: np.ndarray | None = None


def word_table() -> np.ndarray:
    """For each code point whether it belongs to a word: all but ASCII white space."""
    global _words
    if _words is None:
        _words = np.ones(0x110000, bool)
        _words[[32, *range(9, 14)]] = False
    return _words


def grams(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 1 to ``order`` the 64-bit hash of the n words that end at each word (0 where the text
    begins less than n words before), and the number of words of each text."""
    words, counts = word_hashes(texts, word_table())
    nth = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    out, hashed = [], words
    for n in range(1, order + 1):
        if n > 1:
            # from the words before, so that the first n - 1 words' hash is that of their own n-gram
            hashed = mixed(np.concatenate((np.zeros(1, np.uint64), hashed[:-1])) * np.uint64(3) + words)
        out.append(np.where(nth >= n - 1, hashed, np.uint64(0)))
    return out, counts


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different hashes but 0, and how often each occurs."""
    own = np.sort(hashes[hashes != 0])
    first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.zeros(0, np.int64)
    return own[first], np.diff(np.append(first, len(own)))


def packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, compressed: all their first bytes, all second ones and so on, most of which are zero."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def sent(own: np.ndarray, counts: np.ndarray, of: int, bits: int) -> pa.Table:
    """Sorted hashes and their counts as rows of ``BLOCKS``: one for each part, that is for each value of the first ``bits`` bits."""
    part = (own >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), np.int64)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(own) else np.zeros(0, np.int64)
    ends = np.append(first, len(own)).tolist()
    spans = list(zip(ends[:-1], ends[1:], strict=True))
    return pa.table(
        {
            "_part": pa.array(part[first], pa.int64()),
            "_of": pa.array([of] * len(spans), pa.int64()),
            "_grams": pa.array([packed(np.diff(own[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
            "_counts": pa.array([packed(counts[a:b]) for a, b in spans], pa.binary()),
        }
    )


def added_up(blocks: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The hashes of each block; the sorted different ones of all, and the sum of their counts."""
    each = [np.cumsum(unpacked(x), dtype=np.uint64) for x in blocks.column("_grams").to_pylist()]
    counts = np.concatenate([unpacked(x) for x in blocks.column("_counts").to_pylist()])
    own, at = np.unique(np.concatenate(each), return_inverse=True)
    sums = np.zeros(len(own), np.uint64)
    np.add.at(sums, at, counts)
    return each, own, sums


def answers_to(blocks: pa.Table, each: list[np.ndarray], own: np.ndarray, sums: np.ndarray) -> pa.Table:
    """Rows of ``TOTALS``: for each block the sums of its hashes, in its order."""
    totals = [packed(sums[np.searchsorted(own, hashes)]) for hashes in each]
    return pa.table({"_part": blocks.column("_part"), "_of": blocks.column("_of"), "_totals": pa.array(totals, pa.binary())})


def totals_of(blocks: DataFrame, senders: int, fan: int, bits: int, level: int = 1) -> DataFrame:
    """The count table joined back to its askers: for each of the ``BLOCKS`` the totals of its n-grams over all senders.

    Blocks of one part, that is of one range of hashes, meet: of up to ``fan`` senders all at once.
    Of more, each ``fan`` of them are added up to one sender of the next level, which has parts ``bits``
    finer, and its answers are dealt back. So the blocks of a level are as many for each sender
    however many senders there are, and no group holds more than ``fan`` blocks.
    """
    if senders <= fan:

        def count(group: pa.Table) -> pa.Table:
            return answers_to(group, *added_up(group))

        return blocks.groupBy("_part").applyInArrow(count, TOTALS)

    def combine(key: tuple, group: pa.Table) -> pa.Table:
        _, own, sums = added_up(group)
        return sent(own, sums, key[1].as_py(), bits * (level + 1))

    def deal(group: pa.Table, answers: pa.Table) -> pa.Table:
        each, own, _ = added_up(group)
        return answers_to(group, each, own, joined(answers))

    asked = blocks.groupBy("_part", F.floor(F.col("_of") / fan).alias("_over"))
    above = totals_of(asked.applyInArrow(combine, BLOCKS), -(-senders // fan), fan, bits, level + 1)
    return asked.cogroup(above.groupBy(F.shiftright("_part", bits).alias("_part"), F.col("_of").alias("_over"))).applyInArrow(deal, TOTALS)


def joined(answers: pa.Table) -> np.ndarray:
    """The totals of one sender, of its parts in order."""
    parts = sorted(zip(answers.column("_part").to_pylist(), answers.column("_totals").to_pylist(), strict=True))
    return np.concatenate([*(unpacked(x) for _, x in parts), np.zeros(0, np.uint64)])


def asked_for(by_order: list[np.ndarray], of: list[np.ndarray], seen: int) -> list[np.ndarray]:
    """The hashes to be counted next, once the counts ``of`` shorter n-grams are known; 0 where none is needed.

    Words and pairs are counted first. A longer n-gram can be seen ``seen`` times only if its first and its last n - 1 words are.
    """
    if len(of) < 2:
        return by_order[:2]
    frequent = of[-1] >= seen
    return [np.where(frequent & np.concatenate((np.zeros(min(1, len(frequent)), bool), frequent[:-1])), by_order[len(of)], np.uint64(0))]


def counts_at(by_order: list[np.ndarray], rounds: list[np.ndarray], seen: int) -> list[np.ndarray]:
    """For each n as far as there are answers the corpus count of the n-gram that ends at each word."""
    of: list[np.ndarray] = []
    for totals in rounds:
        hashes = asked_for(by_order, of, seen)
        own, _ = distinct(np.concatenate(hashes))
        for h in hashes:
            found = totals[np.minimum(np.searchsorted(own, h), max(0, len(own) - 1))] if len(own) else np.zeros(len(h))
            of.append(np.where(h != 0, found, 0).astype(np.int64))
    return of


def scores(by_order: list[np.ndarray], counts: np.ndarray, of: list[np.ndarray], backoff: float, seen: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of the logarithms of its words' scores but for the corpus size, and the
    number of words at which that size comes in.

    by_order, counts: as of ``grams``; of: the corpus counts of these n-grams.
    """
    total = len(by_order[0])
    log, open_ = np.zeros(total), np.ones(total, bool)
    for n in range(len(by_order), 1, -1):
        there = open_ & (by_order[n - 1] != 0)
        hit = there & (of[n - 1] >= seen)
        at = np.flatnonzero(hit)
        log[at] += np.log(of[n - 1][at]) - np.log(of[n - 2][at - 1])
        log[there & ~hit] += np.log(backoff)
        open_ &= ~hit
    log[open_] += np.log(of[0][open_])
    doc = np.repeat(np.arange(len(counts)), counts)
    sums = lambda x: np.bincount(doc, weights=x, minlength=len(counts))
    return sums(log), sums(open_).astype(np.int64)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, backoff: float = BACKOFF, seen: int = SEEN) -> DataFrame:
    """id, n_words, log_score (natural logarithm, summed over the words) and mean_log_score of each row.

    A word's score is count(n-gram) / count(the n-gram's words but the last) for the longest n-gram
    up to ``order`` that ends there and occurs ``seen`` times or more in all rows, times
    ``backoff`` for each longer one that was tried; if it comes to the word alone, its count
    by the number of all words. Words are runs of anything but ASCII white space; the first of a
    text has nothing before it. A row without a word (null and empty texts too) has log_score 0 and
    a null mean. Repeated rows count as often as they are there.

    Texts are dealt by hash to chunks. A chunk's distinct n-grams, each once with its count, go as
    sorted blocks to the partitions of the count table, by the first bits of the hash. A
    partition adds up the counts and joins them back to every block (``totals_of``); the chunk's
    documents then look up their n-grams and sum. However common an n-gram, it is one entry for
    each chunk, and neither a chunk nor a partition grows with the input. Words and pairs are
    counted first; of n-grams of three and more those go whose shorter ones are all seen often
    enough, without which they can't be. n-grams are compared by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    chars = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    n_chunks = max(1, -(-chars // CHUNK_CHARS))
    levels = 1
    while FAN**levels < n_chunks:
        levels += 1
    fan = next(k for k in range(1, FAN + 1) if k**levels >= n_chunks)
    bits = max(0, ceil(np.log2(fan * CHUNK_CHARS / 2 / PART_GRAMS)))
    # the row, not its id, decides: rows of one id needn't meet in a chunk
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(n_chunks))).groupBy("_chunk")

    def known(chunk: pa.Table, answers: pa.Table | None) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
        by_order, words = grams(chunk.column("_text").to_pylist(), order)
        every = answers.column("_round").to_numpy() if answers is not None else np.zeros(0)
        rounds = [joined(answers.filter(pa.array(every == k))) for k in range(int(every.max()) + 1 if len(every) else 0)]
        return by_order, words, counts_at(by_order, rounds, seen)

    def ask(key: tuple, chunk: pa.Table) -> pa.Table:
        return ask_more(key, chunk, None)

    def ask_more(key: tuple, chunk: pa.Table, answers: pa.Table | None) -> pa.Table:
        by_order, _, of = known(chunk, answers)
        return sent(*distinct(np.concatenate(asked_for(by_order, of, seen))), key[0].as_py(), bits)

    def add_up(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        by_order, words, of = known(chunk, answers)
        of += [np.zeros(len(by_order[0]), np.int64)] * (order - len(of))  # nothing was asked for
        log, sized = scores(by_order, words, of, backoff, seen)
        return pa.table([chunk.column("_id"), pa.array(words.astype(np.int64)), pa.array(log), pa.array(sized)], names=["_id", "_words", "_log", "_sized"])

    answers = None
    for k in range(max(1, order - 1)):
        asked = dealt.applyInArrow(ask, BLOCKS) if answers is None else dealt.cogroup(answers.groupBy("_of")).applyInArrow(ask_more, BLOCKS)
        found = totals_of(asked, n_chunks, fan, bits).withColumn("_round", F.lit(k))
        answers = found if answers is None else answers.unionByName(found)
    summed = checkpointed(dealt.cogroup(answers.groupBy("_of")).applyInArrow(add_up, f"_id {kind}, _words long, _log double, _sized long"))
    size = summed.agg(F.sum("_words").cast("double").alias("_all"))
    log = F.when(F.col("_words") > 0, F.col("_log") - F.col("_sized") * F.log("_all")).otherwise(F.lit(0.0))
    return summed.join(F.broadcast(size)).select(F.col("_id").alias(id_col), F.col("_words").alias("n_words"), log.alias("log_score"), F.when(F.col("_words") > 0, log / F.col("_words")).alias("mean_log_score"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_words, log_score and mean_log_score (to four decimals) of every document, from trigrams of all documents; as of ``lm_scores``."""
    return lm_scores(table(spark, sf_dir, "documents")).select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 4).alias("mean_log_score"))


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)
), p AS (
  SELECT doc_id, word, lag(word) OVER o AS prior, lag(word, 2) OVER o AS before FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY place)
), c1 AS (SELECT word, count(*) AS n FROM w GROUP BY word
), c2 AS (SELECT prior, word, count(*) AS n FROM p WHERE prior IS NOT NULL GROUP BY prior, word
), c3 AS (SELECT before, prior, word, count(*) AS n FROM p WHERE before IS NOT NULL GROUP BY before, prior, word
), s AS (
  SELECT p.doc_id, CASE WHEN c3.n >= 2 THEN ln(c3.n) - ln(b2.n) ELSE (CASE WHEN p.before IS NULL THEN 0 ELSE ln(0.4) END) +
    CASE WHEN c2.n >= 2 THEN ln(c2.n) - ln(b1.n)
    ELSE (CASE WHEN p.prior IS NULL THEN 0 ELSE ln(0.4) END) + ln(c1.n) - ln((SELECT count(*) FROM w)) END END AS l
  FROM p JOIN c1 ON c1.word = p.word
    LEFT JOIN c2 ON c2.prior = p.prior AND c2.word = p.word LEFT JOIN c1 b1 ON b1.word = p.prior
    LEFT JOIN c3 ON c3.before = p.before AND c3.prior = p.prior AND c3.word = p.word LEFT JOIN c2 b2 ON b2.prior = p.before AND b2.word = p.prior
), t AS (SELECT doc_id, count(*) AS n_words, sum(l) AS l FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(l, 0), 4) AS log_score, round(l / n_words, 4) AS mean_log_score
FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id
"""
