import hashlib

import pytest
import regex
import xxhash

from lodestone.llm import fingerprint as P

LOW = 0xFFFFFFFF


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hashed(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), seed=42))


def chained(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed=h)
    return h


def anchors(text):
    """(number of the first token, hash) by the definition: a k-mer whose least s-mer is its first or last."""
    tokens = [hashed(t) for t in regex.findall(P.SINGLE if len(text) < P.SHORT else P.TOKEN, text)]
    if len(tokens) < P.K:
        return [(0, hashed(text) & LOW)] if text else []
    h = [signed(chained(tokens[k : k + P.INNER])) for k in range(len(tokens) - P.INNER + 1)]
    out = []
    for k in range(len(tokens) - P.K + 1):
        window = h[k : k + P.WINDOW]
        if min(window) in (window[0], window[-1]):
            out.append((k, chained([*window[0 :: P.INNER], window[-1]]) & LOW))
    return out


def likeness(a, b):
    first = [{}, {}]
    for held, found in zip(first, (a, b), strict=True):
        for p, v in found:
            held.setdefault(v, p)
    offsets = sorted(first[1][v] - p for v, p in first[0].items() if v in first[1])
    near = max([p for p, _ in a + b], default=0) / P.SLACK
    hit = sum(abs(o - offsets[len(offsets) // 2]) <= near for o in offsets)
    hit += min(len(a) - len(first[0]), len(b) - len(first[1])) if hit else 0
    every = len(a) + len(b) - hit
    return hit / every if every else 1.0


def brute(rows):
    rows = sorted((k, hashed(t or ""), t or "") for k, t in rows)
    out = {}
    for n, (k, _, t) in enumerate(rows):
        follow = rows[(n + 1) % len(rows)][2]
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        own, new, other = map(anchors, (t, edited, follow))
        text = lambda s: "".join(f"{v:08x}" for _, v in s)
        out.setdefault(k, []).append((len(t), hashlib.sha256(edited.encode()).hexdigest(), text(own), text(new), pytest.approx(likeness(own, new)), pytest.approx(likeness(own, other))))
    return out


def result(df):
    out = {}
    for r in sorted(P.edited_fingerprints(df).collect(), key=lambda r: (r.n_chars, r.edited_sha256)):
        out.setdefault(r.doc_id, []).append(tuple(r)[1:])
    return out


def ordered(expected):
    return {k: sorted(v, key=lambda r: r[:2]) for k, v in expected.items()}


def test_edited_matches_brute_force(docs, documents):
    assert result(docs) == ordered(brute(documents))


def test_slices_make_no_difference(docs, documents, monkeypatch):
    monkeypatch.setattr(P, "LARGE", 64)
    monkeypatch.setattr(P, "SMALL", 16)
    monkeypatch.setattr(P, "SLICE", r"(?s).{1,100}+[^\x20\x09-\x0D]{0,30000}+")
    assert result(docs) == ordered(brute(documents))


def test_sparse_ids_small_tables_and_the_hierarchy(spark, monkeypatch):
    fox = "The quick brown fox jumps over the lazy dog. "
    rows = [(-5, "abc"), (3, "x" * 50), (5000, None), (5001, ""), (5002, "😀é" * 15), (10**12, fox * 4), (10**12 + 1, "a"), (10**12 + 2, "ab"), (10**15, fox[:19]), (10**15 + 1, fox[:25]), (10**15 + 9000, "0123456789" * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == ordered(brute(rows))
    monkeypatch.setattr(P, "FLAT", 2)
    assert result(df) == ordered(brute(rows))
    assert result(df.limit(1)) == ordered(brute(rows[:1]))


def test_positions_and_equal_texts(spark):
    text = " ".join(f"Some text {k} that is long enough 😀 to have a number of anchors, and {k * k} more of it." for k in range(8))
    df = spark.createDataFrame([(1, text), (2, text), (3, text[:300] + "inserted" + text[300:]), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.fingerprint(df).collect()}
    assert list(zip(got[1].positions, got[1].anchors, strict=True)) == anchors(text)
    assert got[1].anchors == got[2].anchors
    assert got[1].anchors != got[3].anchors and set(got[1].anchors) & set(got[3].anchors)
    assert got[4].positions == got[4].anchors == []


def test_null_and_repeated_ids(spark, nothing):
    df = spark.createDataFrame([(None, "one text"), (None, "another text"), (7, "same"), (7, "same"), (7, None)], "doc_id long, text string")
    got = P.edited_fingerprints(df).collect()
    assert len(got) == 5 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert P.edited_fingerprints(nothing).count() == 0


def test_an_id_of_many_rows_is_dealt_to_several_buckets(spark):
    rows = [(7, f"text number {k} " * (k % 5)) for k in range(900)] + [(3, "a"), (8, "b c"), (300, "d"), (-4, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == ordered(brute(rows))
    many = P.in_buckets(df.select(P.F.col("doc_id").alias("_id"), P.F.xxhash64("text").alias("_hash")))
    assert many.where("_id = 7").select("_bucket").distinct().count() == 4
    nulls = spark.createDataFrame([(None, f"text {k}") for k in range(700)] + [(1, "x")], "doc_id int, text string")
    got = P.edited_fingerprints(nulls)
    assert got.count() == 701 and got.schema["doc_id"].dataType.simpleString() == "int"


def test_ids_that_are_no_numbers_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        P.edited_fingerprints(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_likeness_goes_by_place(spark):
    import random

    rng = random.Random(3)
    block = lambda: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(300))
    a, b, c = block(), block(), block()
    pairs = {"same": (f"{a} {b}", f"{a} {b}"), "moved": (f"{a} {b}", f"{b} {a}"), "repeated": (f"{a} {b}", f"{a} {b} {a} {b}"), "put in": (f"{a} {b}", f"{a} and a few more words {b}"), "other": (a, c)}
    near = {}
    for name, (x, y) in pairs.items():
        df = spark.createDataFrame([(1, x), (2, y)], "doc_id long, text string")
        near[name] = {r.doc_id: r.near_next for r in P.edited_fingerprints(df).collect()}[1]
    assert near["same"] == 1 and near["other"] == 0 and near["put in"] > 0.9
    assert near["moved"] < 0.4 and 0.4 < near["repeated"] < 0.6


def test_query_on_a_table(spark, documents, tmp_path):
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = P.op5_fingerprint(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert {r.doc_id: [tuple(r)[1:]] for r in got.collect()} == brute(documents)


@pytest.mark.parametrize("unit", ["word ", "!", "x", "é😀 "])
def test_very_long_texts(spark, unit):
    text = unit * (1_500_000 // len(unit))
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in P.edited_fingerprints(df).collect()}
    assert got[1].n_chars == len(text) and got[1].fingerprint and got[2].near_edited <= 1


def test_plan_has_no_python(docs):
    plan = P.edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_anchors_are_free_of_context(spark):
    """An insertion near the beginning of texts without white space leaves what comes after as it was."""
    import base64
    import random

    rng = random.Random(9)
    han = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(4000))
    clauses = "".join(han[k : k + 11] + "，" for k in range(0, 3900, 11))
    coded = base64.b64encode(bytes(rng.randrange(256) for _ in range(3000))).decode()
    minified = "".join(f"function f{k}(a,b){{return a[{k}]+b.x{k}*{k * k}}};" for k in range(120))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2E)) for _ in range(4000))
    for text in (han, clauses, coded, minified, thai, "z" + "".join(rng.choice("!?#$%&/=+-*") for _ in range(3000))):
        df = spark.createDataFrame([(1, text), (2, text[:10] + text[500:501] + text[10:])], "doc_id long, text string")
        first, second = (set(r.anchors) for r in P.fingerprint(df).orderBy("doc_id").collect())
        assert len(first) > 50 and len(first & second) > 0.9 * len(first)
        assert P.edited_fingerprints(df).orderBy("doc_id").first().near_next > 0.8


def test_short_texts_have_a_likeness(spark):
    import random

    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("etaoinshrdlu ") for _ in range(n))
    near = {}
    for n in (32, 64, 127, 200, 255, 300):
        df = spark.createDataFrame([(k, text(n)) for k in range(0, 40)], "doc_id long, text string")
        got = P.edited_fingerprints(df).collect()
        near[n] = sum(r.near_edited for r in got) / len(got)
        assert sum(r.near_next for r in got) / len(got) < 0.03
    assert near[32] > 0.05 and near[64] > 0.15 and all(near[n] > 0.2 for n in (127, 200, 255)), near
