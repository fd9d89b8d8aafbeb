import random

import numpy as np
import pytest

from lodestone.llm import substring_dedup as D


def brute_hashes(raw):
    gear = D.gear_table().tolist()
    h, out = 0, []
    for b in raw:
        h = (2 * h + gear[b]) & 0xFFFF
        out.append(h)
    return out


def test_gear_hash_rolls():
    raw = bytes(random.Random(1).randrange(256) for _ in range(500))
    assert D.gear_hashes(np.frombuffer(raw, np.uint8)).tolist() == brute_hashes(raw)


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghij é😀\n") for _ in range(3000))
    texts = [text, "", text[:700] + "inserted" + text[700:], "x"]
    of, start, end, digest = D.chunks(texts)
    for k, t in enumerate(texts):
        spans = list(zip(start[of == k].tolist(), end[of == k].tolist(), strict=True))
        assert "".join(t[a:b] for a, b in spans) == t
    pieces = {}
    for k, a, b, d in zip(of.tolist(), start.tolist(), end.tolist(), digest.tolist(), strict=True):
        assert pieces.setdefault(d, texts[k][a:b]) == texts[k][a:b]
    one, two = set(digest[of == 0].tolist()), set(digest[of == 2].tolist())
    assert len(one - two) <= 3 and len(two - one) <= 4
    assert all(b - a <= D.LONGEST + 3 for a, b in zip(start.tolist(), end.tolist(), strict=True))
    alone = D.chunks([texts[2]])
    assert alone[3].tolist() == digest[of == 2].tolist() and alone[1].tolist() == start[of == 2].tolist()


def places(rows):
    """By document its chunks in order, (start, end, digest, whether it was there before); by digest its documents, and those found more than once."""
    holders, lists, repeated = {}, {}, set()
    for k, t in rows:
        _, start, end, digest = D.chunks([t or ""])
        seen = set()
        for a, b, d in zip(start.tolist(), end.tolist(), digest.tolist(), strict=True):
            lists.setdefault(k, []).append((a, b, d, d in seen))
            repeated |= {d} & (seen | {x for x in holders if holders[x] - {k}})
            seen.add(d)
            holders.setdefault(d, set()).add(k)
    return holders, lists, repeated


def brute(rows, least=D.LEAST):
    holders, lists, repeated = places(rows)
    out = set()
    for k, own in lists.items():
        run = None
        for a, b, d, before in [*own, (-1, -1, None, False)]:
            shared = d in repeated
            kept = shared and min(holders[d]) == k and not before
            if run and not (shared and run[1] == a and run[3] == kept):
                if run[1] - run[0] >= least:
                    out.add((k, *run))
                run = None
            if shared:
                first = min(holders[d])
                run = (run[0], b, min(run[2], first), kept) if run else (a, b, first, kept)
    return out


def test_matches_brute_force(docs, documents):
    got = D.repeated_passages(docs).collect()
    assert {(r.doc_id, r.start, r.end, r.first_doc, r.kept) for r in got} == brute(documents)
    assert len(got) == len(brute(documents))


def test_planted_passages_are_found_and_others_left(spark):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passages = [text(60) for _ in range(20)]
    rows = [(k, f"{text(100)} {passages[k % 20]} {text(80)}") for k in range(60)] + [(100 + k, text(200)) for k in range(40)]
    got = D.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(60))
    assert {r.doc_id for r in got if r.kept} == set(range(20))


def test_nulls_repeats_and_empty(spark, nothing):
    long = " ".join(f"word{k}" for k in range(200))
    rows = [(1, long), (1, long), (2, None), (3, "")]
    assert D.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    got = D.repeated_passages(spark.createDataFrame([*rows, (4, long), (4, long), (None, long)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.first_doc, r.kept) for r in got if r.doc_id is not None) == [(1, 1, True), (4, 1, False)]
    assert [(r.first_doc, r.kept) for r in got if r.doc_id is None] == [(1, False)]
    got = D.repeated_passages(spark.createDataFrame([(None, long), (2, ""), (None, long)], "doc_id long, text string")).collect()
    assert got == []
    assert D.repeated_passages(nothing).count() == 0


def brute_whole(rows, least=D.LEAST):
    holders, lists, repeated = places(rows)
    out = set()
    for k, own in lists.items():
        parts = []
        for a, b, d, before in own:
            if d in repeated:
                first = min(holders[d])
                kept = first == k and not before
                if parts and parts[-1][1] == a and parts[-1][3] == kept:
                    parts[-1] = (parts[-1][0], b, min(parts[-1][2], first), kept)
                else:
                    parts.append((a, b, first, kept))
        runs, apart = [], True
        for a, b, first, kept in parts:
            other = not kept and b - a >= least
            if runs and runs[-1][1] == a and not other and not apart:
                runs[-1] = (runs[-1][0], b, min(runs[-1][2], first), runs[-1][3] or kept)
            else:
                runs.append((a, b, first, kept))
            apart = other
        out |= {(k, a, b, k if kept else first, kept) for a, b, first, kept in runs if b - a >= least}
    return out


def test_whole_passages_match_brute_force(docs, documents):
    got = [(r.doc_id, r.start, r.end, r.first_doc, r.kept) for r in D.repeated_passages(docs, whole=True).collect()]
    assert set(got) == brute_whole(documents) and len(got) == len(set(got))


def test_query_reports_a_passage_whose_short_chunks_are_elsewhere(spark, tmp_path):
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passage = text(51)
    _, start, end, _ = D.chunks([passage])
    inner = list(zip(start.tolist(), end.tolist(), strict=True))[1:-1]
    # every other inner chunk, with the 16 bytes before it that decide on its start
    rows = [(k, passage[max(0, a - 16) : b + 1]) for k, (a, b) in enumerate(inner[::2])]
    first = f"{text(40)} {passage} {text(40)}"
    rows += [(1000, first), (1001, f"{text(30)} {passage} {text(60)}")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in D.op9_substring_dedup(spark, str(tmp_path)).collect()}
    assert set(got) == {1000, 1001}
    assert got[1000].kept and got[1000].first_doc == 1000 and not got[1001].kept
    at = first.index(passage)
    assert got[1000].start <= at + inner[0][0] and got[1000].end >= at + inner[-1][1]


def test_repeats_within_a_document(spark):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passage = text(60)
    rows = [(1, f"{text(40)} {passage} {text(30)} {passage} {text(20)}"), (2, text(150))]
    got = sorted(D.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.first_doc, r.kept) for r in got] == [(1, 1, True), (1, 1, False)]


@pytest.mark.parametrize("period", ["a", "ab", "word ", "é😀", "etaoin shrdlu x", "0123456789" * 3])
def test_periodic_passages_are_chunked_alike_wherever_they_are(spark, period):
    run = period * (400 // len(period))
    rows = [(1, f"some words before {run} and after"), (2, f"others {run}"), (3, f"{run}tail of another kind")]
    assert all(max(e - s for s, e in zip(a.tolist(), b.tolist(), strict=True)) <= D.LONGEST for _, a, b, _ in [D.chunks([t]) for _, t in rows])
    got = D.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), whole=True).collect()
    assert {r.doc_id for r in got} == {1, 2, 3}
    assert sum(r.n_chars for r in got if r.doc_id != 1) > 400


def test_long_texts_without_boundaries():
    for text in ("z" * 300_000, "ab" * 100_000, "\0" * 70_000):
        _, start, end, digest = D.chunks([text])
        assert end[-1] == len(text) and (end - start).max() <= D.LONGEST and len(set(digest.tolist())) < 20


@pytest.mark.parametrize("whole", [False, True])
def test_texts_of_one_id_are_documents_of_their_own(spark, whole):
    """Repeated and null ids: as if each text had an id of its own, in the order of id and hash."""
    import zlib

    rng = random.Random(12)
    text = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    a, b, passage = text(90), text(90), text(60)
    rows = [(4, a), (4, b), (5, b), (5, b), (6, f"{text(30)} {passage} {text(20)}"), (6, f"{text(40)} {passage} {text(25)}"), (None, f"{text(20)} {passage}"), (None, f"{passage} {text(30)}"), (None, a), (7, text(80)), (7, None), (7, "")]
    crc = lambda t: np.array(zlib.crc32((t or "").encode()), np.uint32).view(np.int32).item()
    order = sorted({(k is None, k or 0, crc(t)) for k, t in rows})
    number = {who: n for n, who in enumerate(order)}
    plain = [(number[k is None, k or 0, crc(t)], t) for k, t in rows]
    back = {n: None if who[0] else who[1] for who, n in number.items()}
    wanted = (brute_whole if whole else brute)(plain)
    got = D.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), whole=whole).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.start, r.end, r.first_doc, r.kept) for r in got), key=key) == sorted(((back[k], x, y, back[f], kept) for k, x, y, f, kept in wanted), key=key)
    assert any(r.doc_id == 4 and r.kept for r in got) and any(r.doc_id == 5 and r.first_doc == 4 for r in got)
