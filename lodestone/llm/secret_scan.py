"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import in_arrow, text_slices
from lodestone.sources.tables import table

#: Fixed patterns of the base spans, and the least length of what must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a maximal run, as is each leftmost match of [0-9a-f]+
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
BASE_KINDS = ("assign", "access", "hex")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class EntropyRule:
    """A character class: the window's width, the entropy in bits from which it counts, and the
    digits, capitals and small letters that what counts must have at least."""

    kind: str
    chars: frozenset[str]
    width: int
    least: float
    digits: int = 0
    upper: int = 0
    lower: int = 0

    def mixed(self, part: str) -> bool:
        count = lambda test: sum(map(test, part))
        return count(str.isdigit) >= self.digits and count(str.isupper) >= self.upper and count(str.islower) >= self.lower


DIGITS, SMALL, LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A candidate belongs to the first class that has all its characters. Windows of 20 random ones have
#: about 3.3, 3.9 and 4.1 bits.
RULES = (
    EntropyRule("entropy_hex", frozenset(DIGITS + "abcdef"), 20, 2.9),
    EntropyRule("entropy_hex", frozenset(DIGITS + "ABCDEF"), 20, 2.9),
    EntropyRule("entropy_base36", frozenset(DIGITS + SMALL), 20, 3.5, digits=1, lower=4),
    EntropyRule("entropy_base36", frozenset(DIGITS + LARGE), 20, 3.5, digits=1, upper=4),
    EntropyRule("entropy_base64", frozenset(DIGITS + SMALL + LARGE + "+/_=-"), 20, 3.7, upper=1, lower=1),
)

#: Candidates of these shapes are no secrets, however their characters are spread.
ALLOW = (
    re.compile(r"[A-Z]?[a-z]+|[A-Z]+"),  # one word
    re.compile(r"[0-9]+"),  # a number
    re.compile(r"[-_=+/]+"),  # a rule
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"),  # a UUID
    re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}[-_A-Za-z0-9]*"),  # begins with a date
)


#: What may be words: letters and punctuation; letters around one number; few digits among letters of one case.
MAYBE_WORDS = (
    re.compile(r"[-_/+=A-Za-z]+"),
    re.compile(r"[A-Za-z]+[0-9]+[A-Za-z]*"),
    re.compile(r"(?=(?:[^0-9]*[0-9]){1,3}[^0-9]*\Z)(?:[a-z0-9]+|[A-Z0-9]+)"),
)
#: The words in it, each capital within beginning another one, and pairs of letters that are frequent in English, French, German or Spanish.
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
PAIRS = frozenset(
    "ab ac ad ag ai al am an ap ar as at au av ba be bi bl bo br bu ca cc ce ch ci ck cl co cr ct cu da de di do du ea ec ed ee ef eg ei el em en ep er es et eu ev ex fa fe ff fi fo fr fu ga ge gh gi "
    "gr gu ha he hi ho ht ia ib ic id ie if ig il im in io ir is it iv ke ki la ld le li ll lo ls lt lu ly ma me mi mm mo mp mu na nc nd ne ng ni nn no ns nt nu ob oc od of ol om on op or os ot ou ov ow "
    "pa pe ph pi pl po pp pr pu qu ra rc rd re rg ri rm rn ro rr rs rt ru ry sa sc se sh si so sp ss st su ta te th ti to tr ts tt tu ty ue ui ul um un up ur us ut va ve vi vo wa we wh wi wo ye ze zu".split()
)
#: The least share of frequent pairs in words. Random pairs are frequent once in three.
LEAST_FREQUENT = 0.55


def wordlike(text: str) -> bool:
    """Whether a string reads as words: of its pairs of neighbours with a letter, punctuation aside,
    so many lie within a word and are frequent."""
    seams = sum((a.isalpha() or b.isalpha()) and a.isalnum() and b.isalnum() for a, b in zip(text, text[1:], strict=False))
    frequent = sum(w[k : k + 2] in PAIRS for w in (x.lower() for x in PART.findall(text)) for k in range(len(w) - 1))
    return frequent >= LEAST_FREQUENT * seams and any(p.fullmatch(text) for p in MAYBE_WORDS)


def peaks(text: str, width: int) -> Iterator[tuple[int, float]]:
    """Where each window of ``width`` characters begins, and its Shannon entropy in bits.

    Counts are kept as the window slides: each step takes one character out and one in, and the
    sum of n*log2(n) changes by these two counts alone.
    """
    if len(text) < width:
        return
    term = [0.0] + [n * math.log2(n) for n in range(1, width + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for k, c in enumerate(text):
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        if k >= width:
            old = text[k - width]
            n = counts[old]
            total += term[n - 1] - term[n]
            counts[old] = n - 1
        if k >= width - 1:
            yield k - width + 1, math.log2(width) - total / width


def runs(text: str, rule: EntropyRule) -> Iterator[tuple[int, int]]:
    """The joined ranges of the windows at or above the rule's entropy."""
    begin = end = -1
    for k, bits in peaks(text, rule.width):
        if bits >= rule.least:
            if k > end:
                if end > begin:
                    yield begin, end
                begin = k
            end = k + rule.width
    if end > begin:
        yield begin, end


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then in the order of the kinds."""
    found = [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return [(a, b, BASE_KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def entropy_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the candidate strings' parts whose windows look random."""
    found = []
    for m in CANDIDATE.finditer(text):
        word = m[0]
        if any(p.fullmatch(word) for p in ALLOW) or wordlike(word):
            continue
        rule = next(r for r in RULES if r.chars.issuperset(word))
        found += [(m.start() + a, m.start() + b, rule.kind) for a, b in runs(word, rule) if rule.mixed(word[a:b]) and not wordlike(word[a:b])]
    return found


def find(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans, and all spans: those and the entropy spans that no base span covers."""
    base = base_spans(text)
    begins = [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))  # of those that begin no later than each, how far one goes
    more = [x for x in entropy_spans(text) if not (k := bisect_right(begins, x[0])) or reach[k - 1] < x[1]]
    return base, sorted(base + more, key=lambda x: (x[0], x[2] not in BASE_KINDS, BASE_KINDS.index(x[2]) if x[2] in BASE_KINDS else 0))


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
SPANS = "array<struct<start:int,end:int,kind:string>>"


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base and spans (arrays of start, end, kind; code points, end exclusive) of each row.

    Texts of any length are scanned whole; null reads as empty, which has no span. Rows are
    independent of each other: nothing is shuffled, repeated rows give repeated results.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for _, texts in text_slices(batch.column(1)):
                for text in texts:
                    own, more = find(text)
                    base.append(own)
                    every.append(more)
            packed = [pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in x] for x in found], pa.list_(SPAN)) for found in (base, every)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *packed], names=[id_col, "base", "spans"])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), scan, f"`{id_col}` {kind}, base {SPANS}, spans {SPANS}")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with all columns; each secret in the text is replaced by its kind in brackets.

    Null text stays null.
    """
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            known = batch.column(at).is_valid().to_pylist()
            for first, texts in text_slices(batch.column(at)):
                for k, text in enumerate(texts):
                    parts, upto = [], 0
                    for a, b, kind in find(text)[1]:
                        if b > upto:
                            parts += [text[upto : max(a, upto)], f"[{kind}]"]
                            upto = b
                    out.append("".join([*parts, text[upto:]]) if known[first + k] else None)
            columns = list(batch.columns)
            columns[at] = pa.array(out, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return in_arrow(docs, clean, docs.schema)


def joined(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base spans' numbers and digest, and all spans, of every document.

    Null and empty texts have none; repeated rows are scanned alike; an empty table gives no row.
    """
    found = secret_scan(table(spark, sf_dir, "documents"))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(of, BASE_KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
