"""Calls under a quota, and the cache."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import writing as W


class Model:
    """Fails at random, as a busy service does; the same prompt fails the same number of times."""

    name = model = "model-1"

    def __init__(self, share=0.4, error=None):
        self.share, self.error, self.rng = share, error, random.Random(1)

    def write(self, system, prompt, tokens):
        assert system == "sys"
        if self.error is not None:
            raise self.error
        if self.rng.random() < self.share:
            raise W.Busy("503", None if self.rng.random() < 0.5 else 17)
        return f" {prompt} by {','.join(tokens)} "


@pytest.fixture(scope="module", autouse=True)
def workers_know_this_module(spark):
    spark.sparkContext.addPyFile(__file__)


def asked(spark, n):
    return spark.createDataFrame([(f"k{k:03d}", f"prompt {k}", ["t", f"u{k}"]) for k in range(n)], "key string, prompt string, tokens array<string>")


def run(spark, path, n, load=Model, wait=lambda s: None, today="2026-01-01", **more):
    ledger = W.Ledger(str(path))
    rows = W.write_prompts(asked(spark, n), load, "sys", ledger, W.Limits(**more.pop("limits", {})), today=today, wait=wait, **more).collect()
    return {r.key: r for r in rows}, ledger


def test_calls_and_waits_are_counted(spark, tmp_path):
    got, ledger = run(spark, tmp_path, 30, limits={"per_day": 200, "writers": 3, "attempts": 6})
    assert {r.status for r in got.values()} <= {"written", "failed"} and sum(r.status == "written" for r in got.values()) >= 28
    assert got["k007"].prose == "prompt 7 by t,u7" and got["k007"].model == "model-1" and got["k007"].generated == "2026-01-01"
    assert sum(r.calls for r in got.values()) == ledger.entries("calls/writer/2026-01-01") > 30
    once = [r for r in got.values() if r.calls == 1]
    assert once and all(r.waited <= 18.0 for r in once) and any(r.waited >= 4 for r in got.values() if r.calls > 1)
    # a second run calls nobody
    kept = {k: r.prose for k, r in got.items() if r.status == "written"}
    again, _ = run(spark, tmp_path, 30, load=lambda: Model(error=ValueError("called")), limits={"per_day": 200})
    assert {k: r.prose for k, r in again.items() if r.status == "written"} == kept and all(again[k].calls == 0 for k in kept)


def test_the_quota_holds_over_runs_and_days(spark, tmp_path):
    steady = lambda: Model(0)
    first, ledger = run(spark, tmp_path, 25, load=steady, limits={"per_day": 10, "writers": 4})
    count = lambda rows: {s: sum(r.status == s for r in rows.values()) for s in {r.status for r in rows.values()}}
    assert count(first) == {"written": 10, "left": 15} and ledger.entries("calls/writer/2026-01-01") == 10
    second, _ = run(spark, tmp_path, 25, load=steady, limits={"per_day": 10})
    assert count(second) == {"written": 10, "left": 15} and ledger.entries("calls/writer/2026-01-01") == 10 and sum(r.calls for r in second.values()) == 0
    fresh, _ = run(spark, tmp_path, 25, load=steady, limits={"per_day": 10}, fresh=True)
    assert count(fresh) == {"left": 25}


def test_what_is_left_is_taken_up_the_next_day(spark, tmp_path):
    steady = lambda: Model(0)
    results, cache = None, str(tmp_path / "cache")
    for day in ("2026-01-01", "2026-01-02", "2026-01-03"):
        todo = asked(spark, 25).join(W.remembered(spark, cache), "key", "left_anti")
        results = W.write_prompts(todo, steady, "sys", W.Ledger(str(tmp_path / "ledger")), W.Limits(per_day=10), today=day, wait=lambda s: None)
        W.remember(results, cache)
    assert W.remembered(spark, cache).count() == 25 and results.count() == 5
    assert sorted({r.generated for r in W.remembered(spark, cache).collect()}) == ["2026-01-01", "2026-01-02", "2026-01-03"]
    assert W.remembered(spark, cache, at="2026-01-02").count() == 20


@pytest.mark.parametrize(("error", "status", "calls"), [(W.QuotaExhausted("gone"), "quota", 1), (W.Busy("wait long", 3600), "quota", 1), (ValueError("blocked"), "failed", 4), (W.Busy("503"), "failed", 12)])
def test_ends(spark, tmp_path, error, status, calls):
    got, ledger = run(spark, tmp_path, 4, load=lambda: Model(error=error), limits={"attempts": 3})
    assert got["k000"].status == status and ledger.entries("calls/writer/2026-01-01") == calls
    assert {r.status for r in got.values()} == ({"quota", "left"} if status == "quota" else {status})
    assert str(error) in got["k000"].error


def test_waits_grow_and_the_pace_is_kept(tmp_path):
    waits = []
    lease = W.Lease(W.Ledger(str(tmp_path)), "calls/x", 9, W.Limits(jitter=0, attempts=4, pace=0), waits.append)
    assert lease.ask(Model(error=W.Busy()), "sys", "k", "p", [])[1] == "failed" and waits == [4, 8, 16]
    waits.clear()
    lease = W.Lease(W.Ledger(str(tmp_path)), "calls/y", 9, W.Limits(jitter=0, writers=2), waits.append)
    for _ in range(3):
        assert lease.ask(Model(0), "sys", "k", "p", [])[1] == "written"
    assert len(waits) == 2 and all(11.9 < w <= 12 for w in waits)
    # a task that is done again finds what its first attempt has used
    assert W.Lease(W.Ledger(str(tmp_path)), "calls/y", 9, W.Limits(), waits.append).left == 6


def test_the_cache_merges_runs(spark, tmp_path):
    path = str(tmp_path / "cache")
    rows = lambda *r: spark.createDataFrame([(k, p, m, "s", d, s) for k, p, m, d, s in r], "key string, prose string, model string, prompt_sha256 string, generated string, status string")
    assert W.remembered(spark, path).count() == 0
    W.remember(rows(("a", "old", "m", "2026-01-01", "written"), ("b", None, "m", "2026-01-01", "failed"), ("c", "fake", "stub", "2026-01-01", "written")), path, "1")
    W.remember(rows(("a", "new", "n", "2026-01-02", "written"), ("d", "x", "n", "2026-01-02", "written")), path, "2")
    W.remember(rows(("a", "same day", "n", "2026-01-02", "written")), path, "3")
    assert sorted((r.key, r.prose, r.run) for r in W.remembered(spark, path).collect()) == [("a", "same day", "3"), ("d", "x", "2")]
    assert spark.read.parquet(path).count() == 4


def test_sections_as_files(spark, tmp_path):
    rows = spark.createDataFrame([("Some prose.\n\nMore: of it.", "m:1", "abc", "2026-01-01")], "prose string, model string, prompt_sha256 string, generated string")
    (text,) = [r[0] for r in rows.select(W.with_header()).collect()]
    assert text == "<!-- cache-meta\nmodel: m:1\nprompt_sha256: abc\ngenerated: 2026-01-01\n-->\nSome prose.\n\nMore: of it."
    (tmp_path / "uni__ghg_scope__0a1b2c3d.md").write_text(text, encoding="utf-8")
    (tmp_path / "uni__a__b__00000000.md").write_text("no header", encoding="utf-8")
    (tmp_path / "README.md").write_text("not a section", encoding="utf-8")
    got = sorted(tuple(r) for r in W.read_sections(spark, str(tmp_path)).collect())
    assert got == [("uni", "a__b", "00000000", "no header", None, None, None, "files"), ("uni", "ghg_scope", "0a1b2c3d", "Some prose.\n\nMore: of it.", "m:1", "abc", "2026-01-01", "files")]
    assert spark.createDataFrame([(text,)], "t string").select(F.size(W.header_fields(F.col("t")))).first()[0] == 3


def test_stand_ins_leave_nothing_and_quotas_are_apart(spark, tmp_path):
    class Stub(Model):
        name = model = "stub"

    got, ledger = run(spark, tmp_path, 3, load=lambda: Stub(0), whose="stub")
    assert {r.status for r in got.values()} == {"written"} and ledger.entries("results") == 0 and ledger.entries("calls/stub/2026-01-01") == 3
    got, _ = run(spark, tmp_path, 3, load=lambda: Model(0), limits={"per_day": 3})
    assert {(r.status, r.model) for r in got.values()} == {("written", "model-1")} and ledger.entries("results") == 3
