import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lodestone.functions.fixed import HEADER_RULE
from lodestone.plans import pipeline
from lodestone.sources import files, schemas, sinks
from lodestone.streaming import upsert as U


def test_csv_marks_quotes_and_drift(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('institution,category,category_code,credit_code,credit_name,status,score,max\n"Univ, A",None,OP,OP-1,"say ""x""",Complete,1.5,N/A\n"B\nC",-,OP,OP-2,---,,x,3\n', encoding="utf-8")
    got = [tuple(r) for r in files.read_csv(spark, str(p), schemas.SCORES).orderBy("credit_code").collect()]
    assert got == [("Univ, A", None, "OP", "OP-1", 'say "x"', "Complete", 1.5, None), ("B\nC", "-", "OP", "OP-2", "---", None, None, 3.0)]
    p.write_text(p.read_text(encoding="utf-8").replace("status", "state"), encoding="utf-8")
    with pytest.raises(Exception):
        files.read_csv(spark, str(p), schemas.SCORES).collect()


def test_json(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"standards": {"S 3": {"title": "T", "family": "F", "source_url": "u", "disclosures": {"3-1": "a", "3-2": "b"}}, "S 4": {"title": "U", "disclosures": {"4-1": "c"}}}}), encoding="utf-8")
    assert sorted((r.standard, r.disclosure, r.title) for r in files.read_vocabulary(spark, f"{tmp_path}/v.json").collect()) == [("S 3", "3-1", "a"), ("S 3", "3-2", "b"), ("S 4", "4-1", "c")]
    (tmp_path / "r.json").write_text(json.dumps({"_readme": "text", "3-1": {"title": "a", "standard": "S 3", "text": "do", "source_url": "u", "cached_source": "c"}}), encoding="utf-8")
    assert [(r.number, r.text) for r in files.read_requirements(spark, f"{tmp_path}/r.json").collect()] == [("3-1", "do")]


def test_corpus_and_pages(spark, tmp_path):
    (tmp_path / "one page.txt").write_text(f"SOURCE: one\nURL: https://x\nWORDS: 3\n{HEADER_RULE}\n\nbody here\n{HEADER_RULE}\nmore\n", encoding="utf-8")
    (tmp_path / "two.txt").write_text("no rule", encoding="utf-8")
    assert sorted(tuple(r) for r in files.read_corpus(spark, str(tmp_path)).collect()) == [("one", "https://x", f"body here\n{HEADER_RULE}\nmore"), ("two", "", "")]
    assert sorted(r.key for r in files.read_pages(spark, str(tmp_path)).collect()) == ["one page", "two"]


def archive(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/") + ".xml", text)
    return out.getvalue()


def test_documents(spark, tmp_path):
    w, s = "http://schemas.openxmlformats.org/wordprocessingml/2006/main", "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    (tmp_path / "a.docx").write_bytes(archive(word__document=f'<w:document xmlns:w="{w}"><w:p><w:r><w:t>Hello </w:t><w:t>there</w:t></w:r></w:p><w:p/><w:p><w:t>Two</w:t></w:p></w:document>'))
    (tmp_path / "b.xlsx").write_bytes(archive(xl__sharedStrings=f'<sst xmlns="{s}"><si><t>x</t></si></sst>', xl__worksheets__sheet1=f'<worksheet xmlns="{s}"><sheetData><row><c t="s"><v>0</v></c><c><v>5</v></c></row><row><c/></row></sheetData></worksheet>'))
    (tmp_path / "c.docx").write_bytes(b"broken")
    (tmp_path / "d.bin").write_bytes(b"x")
    got = {r.file.rsplit("/", 1)[1]: (r.text, r.status) for r in files.extract_documents(spark, str(tmp_path), least=5).collect()}
    assert got == {"a.docx": ("Hello there\nTwo", "ok"), "b.xlsx": ("x | 5", "ok"), "c.docx": (None, "failed: BadZipFile"), "d.bin": (None, "unsupported")}


def test_guarded_write(spark, tmp_path):
    path, good, bad = f"{tmp_path}/out", spark.range(5), spark.range(2)
    checks = {"five rows": lambda df: df.count() == 5}
    assert sinks.guarded_write(good, path, checks) == path
    with pytest.raises(sinks.Incomplete, match="five rows"):
        sinks.guarded_write(bad, path, checks)
    assert sinks.guarded_write(bad, path, checks, f"{tmp_path}/preview") == f"{tmp_path}/preview"
    assert sinks.read_published(spark, path).count() == 5 and sinks.read_published(spark, f"{tmp_path}/preview").count() == 2


def test_markdown_and_exports(spark, tmp_path):
    df = spark.createDataFrame([("g", 2, "b|c"), ("g", 1, "a"), ("h", 1, None)], "g string, n int, v string")
    got = {r.g: r.markdown for r in sinks.markdown_tables(df, ["g"], ["n"], ["n", "v"]).collect()}
    assert got == {"g": "| n | v |\n|---|---|\n| 1 | a |\n| 2 | b\\|c |", "h": "| n | v |\n|---|---|\n| 1 |  |"}
    one = spark.createDataFrame([(["1\n2\n3\n4\nbody", "x"],)], "p array<string>").select(sinks.assembled(F.col("p"), F.lit("front"))).first()[0]
    assert one == "front\n\nbody\n\n"
    sinks.write_csv(df.withColumn("links", F.array(F.lit("a"), F.lit("b"))), f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).where("g = 'h'").first().links == "a b"
    sinks.write_json_lines(df, f"{tmp_path}/j")
    assert files.read_json_lines(spark, f"{tmp_path}/j", df.schema).count() == 3


def test_stream_batches_replace_and_compact(spark, tmp_path):
    a = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    a.coalesce(1).write.parquet(f"{tmp_path}/in")
    run = lambda: U.upsert_stream(U.arriving(spark, f"{tmp_path}/in", a.schema), f"{tmp_path}/out", ["k"], "o", f"{tmp_path}/state")
    run()
    run()  # nothing new
    now = lambda p="out": sorted(tuple(r) for r in U.current(spark, f"{tmp_path}/{p}", ["k"], "o").collect())
    assert now() == [(1, 2, "b"), (2, 1, "c")]
    spark.createDataFrame([(1, 0, "later")], a.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert now() == [(1, 0, "later"), (2, 1, "c")]
    U.compact(spark, f"{tmp_path}/out", f"{tmp_path}/small", ["k"], "o")
    assert now("small") == now()


def test_a_failed_commit_loses_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/out"
    rows = lambda n: spark.range(n).toDF("k")
    now = lambda: sinks.read_published(spark, path).count()
    assert sinks.guarded_write(rows(1), path, {}) == path and now() == 1
    with monkeypatch.context() as m:  # the rows are there and checked, the commit isn't
        m.setattr(sinks, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            sinks.guarded_write(rows(2), path, {})
    assert now() == 1
    (tmp_path / "out" / "_commits" / "000000000001").write_text("0123")  # a commit that was cut off
    assert now() == 1 and [n for n, _ in sinks.commits(spark, path)] == [0]
    reader = sinks.read_published(spark, path)
    sinks.guarded_write(rows(3), path, {})
    assert now() == 3 and [n for n, _ in sinks.commits(spark, path)] == [0, 2] and reader.count() == 1 and sinks.read_published(spark, path, 0).count() == 1
    sinks.guarded_write(rows(4), path, {})
    assert now() == 4 and [n for n, _ in sinks.commits(spark, path)] == [2, 3]
    with monkeypatch.context() as m:  # removing what is old fails: what is new is there all the same
        m.setattr(sinks, "retire", lambda *_: (_ for _ in ()).throw(OSError("busy")))
        with pytest.raises(OSError, match="busy"):
            sinks.guarded_write(rows(5), path, {})
    assert now() == 5
    sinks.guarded_write(rows(6), path, {}, keep=1)
    assert now() == 6 and len(sinks.commits(spark, path)) == 1
    with pytest.raises(sinks.Incomplete):
        sinks.guarded_write(rows(7), f"{tmp_path}/never", {"no": lambda df: False})
    assert not (tmp_path / "never").exists()


def test_two_writers_take_two_numbers(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert [sinks.commit(spark, path, k * 32) for k in "ab"] == [0, 1]
    fs, make = sinks.file_system(spark, path)

    class Late:
        """A listing from before the other writer's commit."""

        def __getattr__(self, name):
            return (lambda _: []) if name == "listStatus" else getattr(fs, name)

    real = sinks.file_system
    try:
        sinks.file_system = lambda *_: (Late(), make)
        assert sinks.commit(spark, path, "c" * 32) == 2
    finally:
        sinks.file_system = real
    assert sinks.commits(spark, path) == [(0, "a" * 32), (1, "b" * 32), (2, "c" * 32)]


def test_order_of_lines_over_files_and_splits(spark, tmp_path):
    names = ["b", "a", "c"]
    sizes = {"a": 3000, "b": 10, "c": 900}
    for name in names:
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{k:05d}\n" for k in range(sizes[name])))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = spark.read.text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        got = files.with_ordinal(lines, "at").orderBy("at").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.at, r.value) for r in got] == list(enumerate(f"{n}{k:05d}" for n in "abc" for k in range(sizes[n])))
    assert files.with_ordinal(spark.read.text(str(tmp_path)), "at").where("value >= 'c'").agg({"at": "min"}).first()[0] == 3010


def test_a_manifest_of_several_files_keeps_its_order(spark, tmp_path):
    from lodestone.sources import schemas

    head = ",".join(schemas.MANIFEST.fieldNames())
    (tmp_path / "texts").mkdir()
    (tmp_path / "manifest").mkdir()
    at = 0
    for part, n in (("1", 40), ("2", 3), ("3", 25)):
        rows = []
        for _ in range(n):
            rows.append(f'https://x/{at},U,OP-1,"a\nfield",name {at}.docx,doc{at}.docx,1,ok,{"long " * (200 if part == "2" else 1)},ok,5')
            (tmp_path / "texts" / f"doc{at}.txt").write_text(f"text {at}")
            at += 1
        (tmp_path / "manifest" / f"part-{part}.csv").write_text(head + "\n" + "\n".join(rows) + "\n")
    got = files.read_manifest(spark, f"{tmp_path}/manifest", f"{tmp_path}/texts").orderBy("ord").collect()
    assert [(r.ord, r.original_name, r.text) for r in got] == [(k, f"name {k}.docx", f"text {k}") for k in range(at)]


def test_archives_are_folders_of_their_members(spark, tmp_path, monkeypatch):
    rows = [(f"a/{k}.csv", f"text {k}".encode()) for k in range(40)] + [("a/0.csv", b"other"), ("b.bin", b"x"), ("c.docx", b"broken"), ("d.csv", None), ("e.zip", b"nested")]
    monkeypatch.setattr(files, "ARCHIVE_BYTES", 30)
    files.write_archives(spark.createDataFrame(rows, "name string, content binary"), f"{tmp_path}/in", each=20)
    written = sorted(p.name for p in (tmp_path / "in").iterdir() if not p.name.endswith(".crc"))
    assert len({n[:11] for n in written}) == 3 and len(written) > 6 and all(n.endswith(".zip") for n in written)
    (tmp_path / "in/z.zip").write_bytes(b"broken")
    (tmp_path / "in/f.csv").write_bytes(b"plain file")
    got = files.extract_documents(spark, f"{tmp_path}/in", least=5, archives=True).collect()
    found = sorted((r.file.split(".zip/")[-1].rsplit("/in/")[-1], r.extension, r.text, r.status) for r in got)
    other = [("a/0.csv", ".csv", "other", "ok"), ("b.bin", ".bin", None, "unsupported"), ("c.docx", ".docx", None, "failed: BadZipFile"), ("e.zip", ".zip", None, "unsupported"), ("f.csv", ".csv", "plain file", "ok"), ("z.zip", ".zip", None, "failed: BadZipFile")]
    assert found == sorted([(f"a/{k}.csv", ".csv", f"text {k}", "ok") for k in range(40)] + other)
    assert {r.status for r in files.extract_documents(spark, f"{tmp_path}/in").where("file like '%.zip'").collect()} == {"unsupported"}
    files.write_archives(spark.createDataFrame([], "name string, content binary"), f"{tmp_path}/none")
    assert files.extract_documents(spark, f"{tmp_path}/none", archives=True).count() == 0


def test_pdfs_of_a_query_are_few_files(spark, tmp_path, monkeypatch):
    spark.range(30).selectExpr("id s_suppkey", "concat('S', id) s_name", "cast(id % 25 as int) s_nationkey", "0.5D s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    read, seen = files.extract_documents, []

    def counted(spark, path, *args, **more):
        seen.append(spark.read.format("binaryFile").load(path).count())
        return read(spark, path, *args, **more)

    monkeypatch.setattr(files, "extract_documents", counted)
    got = {r.s_suppkey: (r.text, r.status) for r in pipeline.pdf_files(spark, str(tmp_path)).collect()}
    assert got == {k: (None, "failed: PdfError") if k % 5 == 0 else (f"S{k} ({k % 25}) of two" + ("" if k % 3 == 0 else "\nbelow it"), "ok") for k in range(30)}
    assert seen == [1]
