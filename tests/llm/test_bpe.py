import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestone.llm import bpe as B

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def test_equals_library(library, documents):
    rng = random.Random(5)
    texts = [t or "" for _, t in documents]
    texts += ["<|endoftext|>", "a<|startoftext|>b <|endoftext|> <|endof", "İSTANBUL ΑΣ ΣΑΣ", "a" * 60, "hahahahaha", "it's we'll I'D", "\x00\x01", "é Å", "日本語 ٣٤ ²½"]
    texts += ["".join(rng.choice("abcdefght 'sélm!.😀ßİΣ\n12<|>") for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["".join(rng.choice("aeinst") for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    own = B.WordBpe(PATH)
    assert list(own.encode(texts)) == [expected(library, t) for t in texts]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(B, "WORDS_KEPT", 5)
    own = B.WordBpe(PATH)
    texts = ["one two three four five six seven", "seven one", "two two", ""]
    for t in texts * 3:
        assert list(own.encode([t])) == [expected(library, t)]


def brute(word, vocab, ranks, suffix):
    parts = [*word[:-1], word[-1] + suffix]
    while True:
        pairs = [(ranks[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not pairs:
            return [vocab[p] for p in parts]
        k = min(pairs)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_merges_whose_result_an_earlier_merge_uses():
    """Tables in which a symbol is made in two ways, so that all places at once would go wrong."""
    rng = random.Random(1)
    alphabet = B.byte_alphabet()
    for _ in range(60):
        vocab = {c: k for k, c in enumerate(alphabet)}
        symbols, merges = list("abc"), []
        while len(merges) < 14:
            pair = (rng.choice(symbols), rng.choice(symbols))
            if pair in merges or len("".join(pair)) > 6:
                continue
            merges.append(pair)
            vocab.setdefault("".join(pair), len(vocab))
            symbols.append("".join(pair))
        rng.shuffle(merges)
        table = B.MergeTable(vocab, [list(p) for p in merges])
        ranks = {p: k for k, p in enumerate(merges)}
        words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 15))) for _ in range(60)] + ["aaaaaaa"]
        ids, sizes = table.encode([w.encode() for w in words])
        at = 0
        for w, n in zip(words, sizes.tolist(), strict=True):
            assert ids[at : at + n].tolist() == brute(w, vocab, ranks, "")
            at += n


def test_operator(docs, documents, library, nothing):
    got = {r.doc_id: r for r in B.bpe_encode(docs, PATH).collect()}
    sums = {r.doc_id: r for r in B.bpe_encode(docs, PATH, digests=True).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for k, t in documents:
        n, ids, decoded = expected(library, t)
        assert (got[k].n_tokens, got[k].ids, got[k].decoded) == (n, ids, decoded)
        assert (sums[k].ids_sha256, sums[k].decoded_sha256) == (sha(ids), sha(decoded))
    assert B.bpe_encode(nothing, PATH).count() == 0
