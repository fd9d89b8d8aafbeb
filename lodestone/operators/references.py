"""References to a vocabulary of many numbers, found by a trie in Arrow batches, as ``text.reference_pattern`` finds those of a few."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import fixed as X
from lodestone.functions import text as T

#: Numbers up to which one pattern of all of them is made, and above which a vocabulary is refused: it is held by the driver and each worker.
PATTERN_NUMBERS, MOST_NUMBERS = 200, 2_000_000
_FLAGS = re.A | re.I
#: Where a reference may begin: the prefix of a vocabulary's number (group 1), or a scope.
_BEGIN = re.compile(rf"(?:(GRI|Disclosures?)\s+)|(?={T.listed('Scopes?', X.SCOPE_ITEM, X.SCOPE_JOINT)})", _FLAGS)
_NUMBERS, _SPELLED = re.compile(X.NUMBER_LIKE, re.A), re.compile(X.SPELLED, re.A)
_SCOPES = re.compile(T.listed("Scopes?", X.SCOPE_ITEM, X.SCOPE_JOINT).removeprefix(r"\b").removesuffix(r"\b"), _FLAGS)
#: What may stand between two numbers of a list, the longest reading first.
_JOINTS = [re.compile(p, _FLAGS) for p in (r"\s*,\s*(?:and\s+|&\s+)", r"\s*,\s*", r"\s+(?:and|&)\s+")]


def is_word(c: str) -> bool:
    return c == "_" or c.isalpha() or c.isdecimal()


def at_edge(text: str, at: int) -> bool:
    """Whether a word begins or ends here."""
    return (at > 0 and is_word(text[at - 1])) != (at < len(text) and is_word(text[at]))


def scopes_end(text: str, begin: int) -> int | None:
    """Where a list of scopes that begins here ends: as many as follow each other, so that a word ends there."""
    whole = _SCOPES.match(text, begin)
    for end in range(whole.end() if whole else begin, begin, -1):
        if at_edge(text, end) and not re.match("[0-9,.][0-9]", text[end : end + 2]) and _SCOPES.fullmatch(text, begin, end):
            return end
    return None


class Trie:
    """A vocabulary's numbers by their characters; case doesn't count."""

    END = ""

    def __init__(self, numbers: Iterable[str]):
        self.root: dict = {}
        for number in numbers:
            node = self.root
            for c in number.lower():
                node = node.setdefault(c, {})
            if node is not self.root:
                node[self.END] = True

    def ends(self, text: str, at: int) -> list[int]:
        """Where numbers that begin here end, the longest first. text: in lower case."""
        node, out = self.root, []
        while at < len(text) and (node := node.get(text[at])) is not None:
            at += 1
            if self.END in node:
                out.append(at)
        return out[::-1]

    def list_end(self, text: str, low: str, at: int) -> int | None:
        """Where a list of numbers that begins here ends: as many as follow each other, so that a word ends there."""

        def following(place: int) -> Iterator[int]:
            for joint in _JOINTS:
                if m := joint.match(low, place):
                    yield from self.ends(low, m.end())

        seen: set[int] = set()
        open_: list[tuple[Iterator[int], int | None]] = [(iter(self.ends(low, at)), None)]
        while open_:
            for end in open_[-1][0]:
                if end not in seen:
                    seen.add(end)
                    open_.append((following(end), end))
                    break
            else:
                _, end = open_.pop()
                if end is not None and at_edge(text, end):
                    return end
        return None

    def spans(self, text: str) -> list[tuple[int, int]]:
        """The references of a text, from left to right."""
        low = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
        out, at = [], 0
        while m := _BEGIN.search(text, at):
            begin, end = m.start(), None
            if at_edge(text, begin):
                if m[1]:
                    end = self.list_end(text, low, m.end())
                else:
                    end = scopes_end(text, begin)
            if end is not None and end > begin:
                out.append((begin, end))
                at = end
            else:
                at = begin + 1
        return out


_tries: dict[str, Trie] = {}
#: Tries that a worker keeps.
TRIES_KEPT = 4


def trie_of(name: str, numbers: Broadcast) -> Trie:
    """The trie of a broadcast vocabulary, built once in a worker; ``name`` is a digest of what is in it."""
    if name not in _tries:
        if len(_tries) >= TRIES_KEPT:
            _tries.clear()
        _tries[name] = Trie(numbers.value)
    return _tries[name]


def numbers_left(text: str, spans: list[tuple[int, int]]) -> list[str]:
    """The numbers of a text outside some spans, without punctuation at their ends."""
    edges = [0, *[k for span in spans for k in span], len(text)]
    return [n.rstrip(".,") for k in range(0, len(edges), 2) for n in _NUMBERS.findall(text, edges[k], edges[k + 1])]


def redacted(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with a mark in place of each number outside some spans."""
    edges = [0, *[k for span in spans for k in span], len(text)]
    return "".join(_NUMBERS.sub("[figure]", text[a:b]) if k % 2 == 0 else text[a:b] for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))


def audited(trie: Trie, text: str, substituted: Iterable[str], context: Iterable[str]) -> dict[str, list[str]]:
    """The four tiers of ``text.audit_digits`` for one text; null texts have no numbers."""
    found = numbers_left(text, trie.spans(text))
    given, near = ({n for t in texts if t is not None for n in numbers_left(t, trie.spans(t))} for texts in (substituted, context))
    rest = set(found) - given
    spelled = {m[1].lower() for m in _SPELLED.finditer(text) if at_edge(text, m.start()) and at_edge(text, m.end())}
    return {"ok": [n for n in found if n in given], "review": sorted(rest & near), "invented": sorted(rest - near), "spelled": sorted(spelled)}


class References:
    """Takes the place of a pattern in ``text.numbers_in``, ``redact_figures`` and ``audit_digits`` where a vocabulary is large.

    The numbers are sent to each executor once; a text is walked once, whatever their number.
    """

    def __init__(self, spark: SparkSession, numbers: Iterable[str]):
        own = sorted({n for n in numbers if n and n.strip() == n})
        name, shared = hashlib.sha256("\0".join(own).encode()).hexdigest(), spark.sparkContext.broadcast(own)
        tiers = ("ok", "review", "invented", "spelled")

        @F.pandas_udf("array<string>")
        def in_each(texts: pd.Series) -> pd.Series:
            trie = trie_of(name, shared)
            return texts.map(lambda t: None if t is None else numbers_left(t, trie.spans(t)))

        @F.pandas_udf("string")
        def redact_each(texts: pd.Series) -> pd.Series:
            trie = trie_of(name, shared)
            return texts.map(lambda t: None if t is None else redacted(t, trie.spans(t)))

        @F.pandas_udf(", ".join(f"{t} array<string>" for t in tiers))
        def audit_each(texts: pd.Series, substituted: pd.Series, context: pd.Series) -> pd.DataFrame:
            trie = trie_of(name, shared)
            rows = [dict.fromkeys(tiers) if t is None else audited(trie, t, a if a is not None else [], b if b is not None else []) for t, a, b in zip(texts, substituted, context, strict=True)]
            return pd.DataFrame({t: [r[t] for r in rows] for t in tiers})

        self.numbers, self.redacted, self.audited = in_each, redact_each, audit_each


def references_of(vocabulary: DataFrame, column: str = "disclosure", few: int = PATTERN_NUMBERS, most: int = MOST_NUMBERS) -> str | References:
    """What finds references to a vocabulary's numbers: a pattern if they are few, else a trie.

    Both find the same. The numbers are collected, so more than ``most`` of them are an error.
    """
    numbers = [r[0] for r in vocabulary.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(numbers) > most:
        raise ValueError(f"a vocabulary of more than {most} numbers")
    return T.reference_pattern(numbers) if len(numbers) <= few else References(vocabulary.sparkSession, numbers)
