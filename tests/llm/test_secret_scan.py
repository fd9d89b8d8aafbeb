import math
import random
import re
from collections import Counter

import pytest

from lodestone.llm import secret_scan as S

HEX40 = "d48fd8e940a86f41832370bc4dd81bc9d95bf72b"
B64 = "kJ8vQ2xZ7pL0sWn4TtYb9RcE1mUhGd5f"


def brute(text):
    out = []
    for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), m.end(), 0))
    for k, (pattern, least) in enumerate([("AKIA[A-Z0-9]+", 20), ("[0-9a-f]+", 24)], 1):
        out += [(m.start(), m.end(), k) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return [(a, b, S.BASE_KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


def test_base_spans_match_brute_force():
    rng = random.Random(9)
    parts = ["password", "PassWd = ", "token", ": '", "api_key=", "APIKEY=\"", "secret", "AKIA", "ABCDEF0123456789", "deadbeef00112233", "0" * 12, " ", "é", "ſecret", "toKen:", "abc.def-12", "\n", "=", "x"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert S.base_spans(text) == brute(text)


@pytest.mark.parametrize("width", [4, 20, 24])
def test_entropy_by_increments_is_entropy(width):
    rng = random.Random(width)
    text = "".join(rng.choice("aabbcdefgh0123") for _ in range(200))
    for k, bits in S.peaks(text, width):
        counts = Counter(text[k : k + width]).values()
        assert bits == pytest.approx(-sum(n / width * math.log2(n / width) for n in counts), abs=1e-9)
    assert list(S.peaks("ab", 3)) == []


def test_entropy_finds_what_patterns_miss_and_leaves_words():
    text = f"key {B64} and {HEX40.upper()} but internationalisation-of-everything 2024-01-01T00-00-00-000-long 123e4567-e89b-12d3-a456-426614174000 {'xy' * 30} retionwhingerbleernd"
    found = {text[a:b]: kind for a, b, kind in S.find(text)[1]}
    assert found == {B64: "entropy_base64", HEX40.upper(): "entropy_hex"}
    assert [k for *_, k in S.find("JB5WY3DPEH4K3PXP7RT2 x")[1]] == ["entropy_base36"]
    assert S.find("a1b2" * 10 + " " + "iso8601datetimeformats version2ofthisdocument")[1] == [(0, 40, "hex")]


def test_base_spans_stay_and_cover(spark):
    text = f"token={HEX40} {B64}"
    base, every = S.find(text)
    assert [k for *_, k in base] == ["assign", "hex"]
    assert set(base) < set(every) and every[-1][2] == "entropy_base64"


def test_operator(docs, documents, spark, nothing):
    got = {r.doc_id: r for r in S.secret_scan(docs).collect()}
    assert len(got) == len(documents)
    assert all(not r.spans for r in got.values() if documents[r.doc_id][1] is None)
    long = spark.createDataFrame([(1, "word " * 50_000 + f"password={HEX40}" + " word" * 10), (1, f"x {HEX40}"), (None, "token: abcdef"), (2, None)], "doc_id long, text string")
    got = sorted(S.secret_scan(long).collect(), key=str)
    assert sorted(len(r.base) for r in got) == [0, 1, 1, 2]
    assert S.secret_scan(nothing).count() == 0


def test_redact(spark):
    df = spark.createDataFrame([(1, f"a password={HEX40} é {B64} z", 7), (2, None, 8), (3, "", 9)], "doc_id long, text string, spans int")
    out = S.redact(df)
    assert out.columns == df.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["a [assign] é [entropy_base64] z", None, ""]


@pytest.mark.parametrize("letters, length, least", [
    ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 20, 0.9),
    ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 20, 0.95),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 20, 0.88),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32, 0.98),
    ("abcdefghijklmnopqrstuvwxyz0123456789", 20, 0.93),
])
def test_random_keys_are_found(letters, length, least):
    rng = random.Random(length)
    keys = ["".join(rng.choice(letters) for _ in range(length)) for _ in range(1000)]
    assert sum(bool(S.find(f"key {k} end")[1]) for k in keys) >= least * len(keys)


def test_names_and_words_are_left():
    names = (
        "getElementByIdFromDocument AbstractSingletonProxyFactoryBean the-Quick-Brown-Fox/jumps_over /usr/Local/share/Documents/README INTERNATIONALIZATION_SETTINGS Donaudampfschifffahrtsgesellschaft "
        "anticonstitutionnellement utf8mb4unicodecitable1 Covid19VaccinationProgramme XMLHttpRequestUpload KnowYourCustomerPolicy2024 sha256withrsaencryption"
    )
    assert [w for w in names.split() if S.find(w)[1]] == []


def test_many_secrets_take_their_time_once():
    import random
    import time

    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: "".join(rng.choice(alphabet) for _ in range(32))
    text = " ".join(f"token={word()} {word()}" for _ in range(20_000))
    begin = time.monotonic()
    base, every = S.find(text)
    assert time.monotonic() - begin < 30 and len(base) == 20_000 and len(every) > 38_000
    assert every == sorted(every, key=lambda x: x[0])
