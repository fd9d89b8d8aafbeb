"""BPE encoding and decoding by batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import in_arrow, text_slices
from lodestone.sources.tables import table

#: Fixed: what counts as white space in the tokenizer's patterns.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same classes below U+0250, for the faster engine of the standard library.
LATIN_WHITE, LATIN_LETTERS, LATIN_DIGITS = r"\t-\r \x85\xa0", r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: Words whose pieces a worker keeps; beyond this number it starts anew, so its memory is bounded.
WORDS_KEPT = 300_000


_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def is_latin(text: str) -> bool:
    """Whether all code points are below U+0250."""
    return text.isascii() or _BEYOND_LATIN.search(text) is None


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class MergeTable:
    """A vocabulary and its merges as sorted arrays of pair keys."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str] | str], suffix: str = ""):
        pairs = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in merges]
        self.size, self.suffix = max(vocab.values()) + 1, suffix
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # a symbol that some earlier merge uses may have to be merged on before its twin is made
        first_use = np.full(self.size, len(pairs), np.int64)
        for k in range(len(pairs) - 1, -1, -1):
            first_use[left[k]] = first_use[right[k]] = k
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.by_rank, self.none = keys[order], order, made, len(pairs)
        self.at_once = first_use[made] > np.arange(len(pairs))
        names = byte_alphabet()
        self.inner = np.array([vocab.get(c, -1) for c in names], np.int64)
        self.last = np.array([vocab.get(c + suffix, -1) for c in names], np.int64)
        if min(self.inner.min(), self.last.min()) < 0:
            raise ValueError("the vocabulary lacks a byte")

    def look_up(self, symbols: np.ndarray, word: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        """Set the ranks of the pairs that begin at these places."""
        rank[at] = self.none
        at = at[at < len(symbols) - 1]
        at = at[word[at] == word[at + 1]]
        if not self.none or not len(at):
            return
        key = symbols[at] * self.size + symbols[at + 1]
        found = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        hit = self.keys[found] == key
        rank[at[hit]] = self.rank[found[hit]]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in one array, and the number of ids of each word.

        In each round every word that can still be merged merges its pair of lowest rank: all of
        its places if that can't change what comes after, else the leftmost. Words of which no
        pair is in the table leave the array.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)
        some = sizes > 0
        symbols[ends[some] - 1] = self.last[raw[ends[some] - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(symbols))
        rank = np.full(len(symbols), self.none, np.int64)
        self.look_up(symbols, word, rank, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lengths = np.diff(np.append(starts, len(word)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            over = lowest == self.none
            if over.any():
                done.append((word[over], place[over], symbols[over]))
                stay = ~over
                symbols, word, place, rank, lowest = symbols[stay], word[stay], place[stay], rank[stay], lowest[stay]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == lowest)
            # leftmost only, where the merge's result may be used by an earlier merge
            first = np.concatenate(([True], word[at[1:]] != word[at[:-1]]))
            at = at[first | self.at_once[lowest[at]]]
            # of neighbours that overlap, as in "aaa", every other one from the left
            fresh = np.concatenate(([True], at[1:] != at[:-1] + 1))
            head = np.flatnonzero(fresh)
            nth = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
            at = at[nth % 2 == 0]
            symbols[at] = self.by_rank[lowest[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, place, rank = symbols[keep], word[keep], place[keep], rank[keep]
            made = at - np.arange(len(at))  # where they are now, after as many removals
            self.look_up(symbols, word, rank, np.concatenate((made, made[made > 0] - 1)))
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, place, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place)
        return symbols[order], np.bincount(word, minlength=len(words))


class WordBpe:
    """A word-end BPE tokenizer, read from a file of the ``tokenizers`` library.

    Reads NFC, white space runs to one space and lower case as normalisers; splits by the file's
    pattern; byte-level symbols, the last of a word with the word-end suffix. Strings of special
    tokens in a text are those tokens. Every byte must be in the vocabulary.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError(f"{path}: not a tokenizer of this kind")
        model = spec["model"]
        self.table = MergeTable(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.names = [""] * self.table.size
        for name, k in model["vocab"].items():
            self.names[k] = name
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_id = {k: name for name, k in self.special.items()}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", WHITE))
        self.latin_words = re.compile(pattern.replace(r"\s", LATIN_WHITE).replace(r"\p{L}", LATIN_LETTERS).replace(r"\p{N}", LATIN_DIGITS))
        self.kept: dict[str | int, tuple[int, str, str]] = {}

    def split(self, text: str) -> list[str | int]:
        """The words of a text in order; a special token is its id."""
        if self.cut and "<|" in text:
            out: list[str | int] = []
            upto = 0
            for m in self.cut.finditer(text):
                out += [*self.plain(text[upto : m.start()]), self.special[m[0]]]
                upto = m.end()
            return [*out, *self.plain(text[upto:])]
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case regardless of place
        text = text.lower()
        # no word has white space, so its runs needn't be made one space first
        return (self.latin_words if is_latin(text) else self.words).findall(text)

    def learn(self, lists: list[list[str | int]]) -> None:
        """Encode the words that aren't known, all at once."""
        if len(self.kept) > WORDS_KEPT:
            self.kept.clear()
        kept = self.kept
        new = {w for words in lists for w in words if w not in kept}
        words = [w for w in new if isinstance(w, str)]
        ids, sizes = self.table.encode([w.encode("utf-8", "surrogatepass") for w in words])
        flat, at = ids.tolist(), 0
        for w, n in zip(words, sizes.tolist(), strict=True):
            own = flat[at : at + n]
            at += n
            self.kept[w] = (n, " ".join(map(str, own)), self.decode(own))
        for k in new.difference(words):
            self.kept[k] = (1, str(k), self.by_id[k])

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by spaces, special ones included, as the file states no decoder."""
        return " ".join([self.by_id.get(k) or self.names[k] for k in ids])

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text its number of ids, the ids and the decoded text, both joined by spaces."""
        lists = [self.split(t) for t in texts]
        self.learn(lists)
        for words in lists:
            got = [self.kept[w] for w in words]
            if got:
                n, ids, tokens = zip(*got, strict=True)
                yield sum(n), " ".join(ids), " ".join(tokens)
            else:
                yield 0, "", ""


_loaded: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The tokenizer, read once in a worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """id, n_tokens, ids (decimal, joined by spaces) and decoded of each row.

    With ``digests`` the SHA-256 of both strings stands in their place, so that they needn't leave
    the worker. Null text reads as empty, which has no id. Texts are encoded whole; rows are
    independent and nothing is shuffled. ``path`` is read on the executors: it is part of
    their installation, like the libraries.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            counts, ids, back = [], [], []
            for _, texts in text_slices(batch.column(1)):
                for n, own, decoded in bpe.encode(texts):
                    counts.append(n)
                    ids.append(hashlib.sha256(own.encode()).hexdigest() if digests else own)
                    back.append(hashlib.sha256(decoded.encode()).hexdigest() if digests else decoded)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=[id_col, "n_tokens", *names])

    return in_arrow(docs.select(F.col(id_col), F.col(text_col)), run, f"`{id_col}` {kind}, n_tokens long, {names[0]} string, {names[1]} string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document, and digests of its ids and of what they decode to.

    Null and empty texts have no token; repeated rows are encoded alike; an empty table gives no row.
    """
    import public_tokenizers

    return bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)
