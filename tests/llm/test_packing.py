import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestone.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library, documents, monkeypatch):
    rng = random.Random(5)
    texts = [t or "" for _, t in documents] + ["<|endoftext|>", "a<|endoftext|>b  <|endoftext|>", "  a  b\n\n c", "\x85 \x1c\x1cq ᠎ x", "it's we'll I'D '' '", " \t\n ", "²½ ٣ ª"]
    texts += ["".join(rng.choice("abc 'sélm!.😀ßİΣ\n12<|>\t\xa0") for _ in range(rng.randrange(60))) for _ in range(1500)]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    own = P.CachedTokenizer(PATH)
    assert [i.tolist() for i in own.encode(texts)] == expected
    monkeypatch.setattr(P, "WORDS_KEPT", 3)
    assert [next(own.encode([t])).tolist() for t in texts[:200]] == expected[:200]


def test_cut():
    for n in (1, 5, 2047, 2048, 2049, 4096, 5000, 6144):
        parts = P.cut(n)
        assert [a for a, _ in parts] == [0, *np.cumsum([s for _, s in parts])[:-1].tolist()]
        assert sum(s for _, s in parts) == n and all(s == 2048 for _, s in parts[1:])


def test_bins_hold_and_are_few():
    rng = random.Random(2)
    for length, n in ((10, 40), (64, 500), (2048, 4000)):
        for most in (length, length // 2, length // 3):
            sizes = [rng.randrange(1, most + 1) for _ in range(n)]
            of_bin, offset, bins = P.best_two_fit(sizes, length)
            inside = defaultdict(list)
            for k, b in enumerate(of_bin):
                inside[b].append((offset[k], sizes[k]))
            assert len(inside) == bins
            for parts in inside.values():
                at = 0
                for o, s in sorted(parts):
                    assert o == at
                    at += s
                assert at <= length
            greedy = []
            for s in sorted(sizes, reverse=True):  # first fit decreasing
                for k, free in enumerate(greedy):
                    if s <= free:
                        greedy[k] -= s
                        break
                else:
                    greedy.append(length - s)
            # items above half a bin leave no choice of pairs; there the method may need some more
            assert bins <= (1.02 * len(greedy) + 1 if most == length else len(greedy))


def test_two_replace_the_smallest():
    # greedy puts 6 and 3 into 10; 3 gives way to 2 and 2, which fill the gap of 4
    of_bin, _, bins = P.best_two_fit([6, 3, 2, 2], 10)
    assert of_bin[0] == of_bin[2] == of_bin[3] != of_bin[1] and bins == 2
    assert P.best_two_fit([], 10) == ([], [], 0)


def test_operator(docs, documents, library, nothing):
    rows = P.pack_documents(docs, PATH).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == {k for k, _ in documents}
    for k, t in documents:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert [(r.start, r.length) for r in sorted(by_doc[k], key=lambda r: r.piece)] == P.cut(len(ids))
        for r in by_doc[k]:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for parts in by_bin.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert P.pack_documents(nothing, PATH).count() == 0


def test_repeated_rows_and_several_groups(spark):
    df = spark.createDataFrame([(1, "a b c")] * 30 + [(None, None)] * 5 + [(2, "word " * 3000)], "doc_id long, text string")
    pieces = P.tokenised(df, PATH).drop("ids")
    out = P.pack(pieces, 36, docs_at_once=10).collect()
    assert len(out) == pieces.count()
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
