"""Prompts written by executors under leases of a daily quota, and the cache of what they wrote."""

from __future__ import annotations

import datetime
import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions.stages import written
from lodestone.operators.joins import keep
from lodestone.operators.narrative import Writer

RESULTS = "key string, prose string, model string, prompt_sha256 string, generated string, status string, calls int, waited double, error string"
CACHE = "key string, prose string, model string, prompt_sha256 string, generated string, run string"


#: Names of writers that only stand in for one: what they write is never kept.
STAND_INS = ("stub", "rogue")


class WriterError(RuntimeError):
    """A writer gave no prose, and would give none if it were asked again."""


class Busy(WriterError):
    """A writer can't just now; ``after``: seconds that it says to wait, if it says so."""

    def __init__(self, message: str = "", after: float | None = None):
        super().__init__(message)
        self.after = after


class QuotaExhausted(WriterError):
    """A writer gives nothing more today; any further call would be in vain, and counted."""


@dataclass(frozen=True)
class Limits:
    """How a writer may be called: calls a day by all runs together, seconds between two calls, attempts at a prompt.

    After the n-th failed attempt backoff * 2 ** (n - 1) seconds pass, and up to ``jitter`` more; or what the writer says, if that is
    no more than ``longest_wait``. ``writers`` leases of the day's rest are given out at once; each has its share of the pace.
    """

    per_day: int = 20
    pace: float = 6.0
    attempts: int = 5
    backoff: float = 4.0
    jitter: float = 2.0
    longest_wait: float = 120.0
    writers: int = 1


class Ledger:
    """The calls of each day and what they gave, as small files in a folder that driver and executors share.

    A call is entered before it is made and a result as soon as it is there, so that a task that is done
    again, or a run that dies, neither forgets a call nor makes one twice for a prompt.
    """

    def __init__(self, path: str):
        self.path = path

    def place(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", self.path))

    def entries(self, folder: str) -> int:
        fs, root = self.place()
        found = fs.get_file_info(pafs.FileSelector(f"{root}/{folder}", recursive=True, allow_not_found=True))
        return sum(i.type == pafs.FileType.File for i in found)

    def enter(self, folder: str, name: str, text: str = "") -> None:
        """A whole file at once: written under another name, then moved."""
        fs, root = self.place()
        fs.create_dir(f"{root}/{folder}", recursive=True)
        fs.create_dir(f"{root}/fresh", recursive=True)
        fresh = f"{root}/fresh/{uuid.uuid4().hex}"
        with fs.open_output_stream(fresh) as f:
            f.write(text.encode())
        fs.move(fresh, f"{root}/{folder}/{name}")

    def read(self, folder: str, name: str) -> dict | None:
        fs, root = self.place()
        if fs.get_file_info(f"{root}/{folder}/{name}").type != pafs.FileType.File:
            return None
        with fs.open_input_file(f"{root}/{folder}/{name}") as f:
            return json.loads(f.read())


def shake(key: str, attempt: int) -> float:
    """A number from 0 to 1 that a prompt and an attempt always give: what spreads retries out."""
    return int.from_bytes(hashlib.sha256(f"{key}\0{attempt}".encode()).digest()[:4], "little") / 2**32


class Lease:
    """What one task may do: so many calls, at its share of the pace, waiting where it has to."""

    def __init__(self, ledger: Ledger, folder: str, calls: int, limits: Limits, wait: Callable[[float], None]):
        self.ledger, self.folder, self.limits, self.wait = ledger, folder, limits, wait
        self.left = calls - ledger.entries(folder)
        self.last: float | None = None

    def rest(self, seconds: float) -> float:
        if seconds > 0:
            self.wait(seconds)
        return max(0.0, seconds)

    def ask(self, writer: Writer, system: str, key: str, prompt: str, tokens: Sequence[str]) -> tuple[str | None, str, int, float, str | None]:
        """(prose, status, calls, seconds waited, error) of one prompt. status: written, failed, quota (the writer's is gone), left (the lease is used up)."""
        limits, calls, waited = self.limits, 0, 0.0
        error: str | None = None
        for attempt in range(1, limits.attempts + 1):
            if self.left <= 0:
                return None, "left", calls, waited, error
            if self.last is not None:
                waited += self.rest(limits.pace * limits.writers - (time.monotonic() - self.last))
            self.ledger.enter(self.folder, uuid.uuid4().hex)
            self.left -= 1
            calls += 1
            try:
                prose = (writer.write(system, prompt, tokens) or "").strip()
                self.last = time.monotonic()
                if prose:
                    return prose, "written", calls, waited, None
                return None, "failed", calls, waited, "the writer gave nothing"
            except QuotaExhausted as e:
                return None, "quota", calls, waited, str(e)
            except Busy as e:
                self.last, error = time.monotonic(), str(e) or "busy"
                if e.after is not None and e.after > limits.longest_wait:
                    return None, "quota", calls, waited, error
                if attempt < limits.attempts:
                    waited += self.rest(limits.backoff * 2 ** (attempt - 1) + limits.jitter * shake(key, attempt) if e.after is None else e.after + limits.jitter)
            except Exception as e:  # what a writer raises is a prompt's status, not the job's end
                return None, "failed", calls, waited, f"{type(e).__name__}: {e}"
        return None, "failed", calls, waited, error


def write_prompts(
    asked: DataFrame, load: Callable[[], Writer], system: str, ledger: Ledger, limits: Limits = Limits(), fresh: bool = False, today: str | None = None, wait: Callable[[float], None] = time.sleep, whose: str = "writer"
) -> DataFrame:
    """What a writer makes of prompts (key, prompt, tokens), each once: rows of RESULTS, computed and kept when this returns.

    Of today's calls that the ledger has left, each of ``writers`` leases gets a share, and a task makes its calls one after the other.
    A prompt beyond the rest, and every one after a writer's quota is gone, has the status left: a later run asks for it. What
    the ledger has as result is not asked again, unless ``fresh``. ``load`` makes the writer in a task; ``whose`` names the quota that it draws on.
    No more prompts than the day has calls are taken at once, so that a lease fits its task.
    """
    spark = asked.sparkSession
    day = today or datetime.date.today().isoformat()
    rest = max(0, limits.per_day - ledger.entries(f"calls/{whose}/{day}"))
    once = keep(asked.select("key", "prompt", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")), ["key", "prompt"], [F.col("tokens")])
    taken = once.orderBy("key", "prompt").limit(max(rest, limits.per_day))
    writers = max(1, min(limits.writers, rest or 1))
    run = uuid.uuid4().hex
    results = f"results/{run}" if fresh else "results"
    # one order of what a day's calls can take, so that the leases' shares are even
    leased = taken.withColumn("_lease", (F.row_number().over(Window.orderBy("key", "prompt")) - 1) % writers)

    def write(key: tuple, rows: pa.Table) -> pa.Table:
        nth = key[0].as_py()
        lease = Lease(ledger, f"calls/{whose}/{day}/{run}-{nth}", rest // writers + (nth < rest % writers), limits, wait)
        writer, over, out = None, False, []
        for r in sorted(rows.select(["key", "prompt", "tokens"]).to_pylist(), key=lambda r: (r["key"], r["prompt"])):
            sha = hashlib.sha256(r["prompt"].encode()).hexdigest()
            kept = ledger.read(results, f"{r['key']}-{sha[:16]}")
            if kept is not None:
                out.append(kept | {"calls": 0, "waited": 0.0})
                continue
            if over:
                out.append({"key": r["key"], "prompt_sha256": sha, "status": "left", "calls": 0, "waited": 0.0})
                continue
            writer = writer or load()
            prose, status, calls, waited, error = lease.ask(writer, system, r["key"], r["prompt"], r["tokens"])
            over = status in ("quota", "left")
            row = {"key": r["key"], "prose": prose, "model": getattr(writer, "model", writer.name), "prompt_sha256": sha, "generated": day, "status": status, "calls": calls, "waited": waited, "error": error}
            if status == "written" and writer.name not in STAND_INS:
                ledger.enter(results, f"{r['key']}-{sha[:16]}", json.dumps(row))
            out.append(row)
        return pa.Table.from_pylist(out, schema=_SCHEMA)

    done = written(leased.groupBy("_lease").applyInArrow(write, RESULTS))
    others = once.withColumn("prompt_sha256", F.sha2("prompt", 256)).join(done.select("key", "prompt_sha256"), ["key", "prompt_sha256"], "left_anti").select("key", "prompt_sha256", F.lit("left").alias("status"), F.lit(0).alias("calls"), F.lit(0.0).alias("waited"))
    return done.unionByName(others, allowMissingColumns=True)


_SCHEMA = pa.schema([("key", pa.string()), ("prose", pa.string()), ("model", pa.string()), ("prompt_sha256", pa.string()), ("generated", pa.string()), ("status", pa.string()), ("calls", pa.int32()), ("waited", pa.float64()), ("error", pa.string())])


def counted(results: DataFrame) -> DataFrame:
    """(status, prompts, calls, waited): what a run did."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("prompts"), F.sum("calls").alias("calls"), F.round(F.sum("waited"), 3).alias("waited"))


# --- the cache


def remember(results: DataFrame, path: str, run: str | None = None, never: Sequence[str] = STAND_INS) -> None:
    """Append what was written to a cache folder, as one version of its keys. Nothing there is changed; what stand-ins wrote isn't kept.

    ``run`` names the version; by default it begins with the time, and the last one counts.
    """
    new = results.where((F.col("status") == "written") & ~F.col("model").isin(*never))
    new.select("key", "prose", "model", "prompt_sha256", "generated", F.lit(run or f"{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}").alias("run")).write.mode("append").parquet(path)


def remembered(spark: SparkSession, path: str, at: str | None = None) -> DataFrame:
    """The cache's last version of each prompt (key, prose, model, prompt_sha256, generated, run), or as it was on a day; several runs' rows are merged by key and hash.

    A folder that isn't there yet has none.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], CACHE)
    rows = spark.read.schema(CACHE).parquet(path)
    rows = rows if at is None else rows.where(F.col("generated") <= at)
    return keep(rows, ["key", "prompt_sha256"], [F.col("generated").desc(), F.col("run").desc(), F.col("prose")])


def with_header(prose: str = "prose", model: str = "model", sha: str = "prompt_sha256", generated: str = "generated") -> Column:
    """A cached section as a text file has it: where it comes from, in a comment, then the prose."""
    lines = [F.concat(F.lit(f"{name}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for name, c in (("model", model), ("prompt_sha256", sha), ("generated", generated))]
    return F.concat(F.lit("<!-- cache-meta\n"), F.array_join(F.array(*lines), "\n"), F.lit("\n-->\n"), F.col(prose))


HEADER = r"(?s)\A<!--\s*cache-meta\n(.*?)\n-->\n"


def header_fields(text: Column) -> Column:
    """A map of what a cached section's comment says; empty without one."""
    lines = F.filter(F.split(F.regexp_extract(text, HEADER, 1), "\n"), lambda s: F.contains(s, F.lit(":")))
    pairs = F.transform(lines, lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)).alias("key"), F.trim(F.regexp_replace(s, r"^[^:]*:", "")).alias("value")))
    return F.map_from_entries(pairs)


def without_header(text: Column) -> Column:
    return F.regexp_replace(text, HEADER, "")


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """Cached sections kept as text files named OWNER__SECTION__KEY: owner, section, and the columns of a cache."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1).alias("_name"), "value")
    parts, fields = F.split("_name", "__"), header_fields(F.col("value"))
    named = raw.where(F.size(parts) >= 3)
    return named.select(
        F.element_at(parts, 1).alias("owner"), F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "__").alias("section"), F.element_at(parts, -1).alias("key"), without_header(F.col("value")).alias("prose"),
        *[F.element_at(fields, c).alias(c) for c in ("model", "prompt_sha256", "generated")], F.lit("files").alias("run"),
    )
