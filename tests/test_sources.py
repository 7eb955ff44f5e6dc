import json

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.schema import METADATA, STAGING


def by_name(df):
    return {r["source_metadata"]["file_name"]: r for r in df.collect()}


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in dir"
    d.mkdir()
    (d / "a+b c.log").write_bytes(b"one\r\ntwo\rthree\n")
    (d / "bad.txt").write_bytes(b"caf\xc3\xa9 \xff\xfe ok \xc3")
    (d / "UP.LOG").write_bytes(b"upper")
    (d / "empty.log").write_bytes(b"")
    (d / "big.log").write_bytes(b"x" * (1024 * 1024 + 1))
    (d / "skip.csv").write_bytes(b"no")
    (d / "doc.pdf").write_bytes(b"%PDF")
    (d / "Word.DOCX").write_bytes(b"PK")
    return d


def test_read_error_logs(spark, folder):
    df = bs.read_error_logs(spark, str(folder), max_mb=1)
    assert df.schema["source_metadata"].dataType.fieldNames() == METADATA.fieldNames()
    got = by_name(df)
    assert set(got) == {"a+b c.log", "bad.txt", "UP.LOG", "big.log", "empty.log"}
    assert (got["empty.log"]["text"], got["empty.log"]["source_metadata"]["file_size_bytes"]) == ("", 0)
    a = got["a+b c.log"]
    assert a["text"] == "one\ntwo\nthree\n"
    assert a["source_metadata"]["source_id"] == str(folder / "a+b c.log")
    assert (a["source_metadata"]["file_size_bytes"], a["source_metadata"]["raw_text_length"]) == (15, 14)
    assert got["bad.txt"]["text"] == "café  ok "
    big = got["big.log"]
    assert big["text"] is None
    assert big["reject_reason"] == "File size (1.00 MB) exceeds maximum allowed (1 MB)"
    good, rejects = bs.split_rejects(df)
    assert good.count() == 4
    assert [r["item"] for r in bs.failed_items(rejects).collect()] == ["big.log"]


def test_oversize_files_are_not_read(spark, folder):
    files = spark.read.option("pathGlobFilter", "*.log").text(str(folder), wholetext=True)
    scan = files.where(F.col("_metadata.file_size") <= 1024)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "file_size" in plan
    assert scan.count() == 1


def test_empty_files(spark, folder):
    manifest = spark.createDataFrame(
        [(str(folder / "empty.log"), 0), ("/x/a.log", 5), ("/x/e.pdf", 0)], "path string, length long"
    )
    (row,) = bs.empty_files(manifest).collect()
    assert (row["text"], row["source_metadata"]["file_name"]) == ("", "empty.log")


def test_scan_directory(spark, folder):
    got = by_name(bs.scan_directory(spark, str(folder)))
    assert set(got) == {"a+b c.log", "bad.txt", "big.log", "empty.log"}


def test_binary_docs(spark, folder):
    got = by_name(bs.read_binary_docs(spark, str(folder)))
    assert {n: r["text"] for n, r in got.items()} == {
        "doc.pdf": "[PDF content from doc.pdf]", "Word.DOCX": "[DOC content from Word.DOCX]",
    }
    assert got["doc.pdf"]["source_metadata"]["file_size_bytes"] == 4


def test_missing_and_unsupported_files(spark, folder):
    staging = bs.read_error_logs(spark, str(folder))
    asked = spark.createDataFrame([(str(folder / "UP.LOG"),), (str(folder / "gone.log"),)], "path string")
    got = bs.missing_files(asked, staging).collect()
    assert [r["reject_reason"] for r in got] == [f"File not found: {folder / 'gone.log'}"]
    manifest = spark.createDataFrame(
        [("/x/a.LOG", 10), ("/x/a.csv", 10), ("/x/a.txt", 60 * 1024 * 1024), ("/x/b.log", None), ("/x/.log", 1)],
        "path string, length long",
    )
    reasons = {r["path"]: r["reject_reason"] for r in bs.check_manifest(manifest).collect()}
    assert reasons == {
        "/x/a.LOG": None, "/x/a.csv": "Unsupported file type: .csv",
        "/x/a.txt": "File size (60.00 MB) exceeds maximum allowed (50 MB)",
        "/x/b.log": "File not found: /x/b.log", "/x/.log": "Unsupported file type: ",
    }


def test_read_freetext(spark):
    rows = [(0, "  hi\x00 there \n"), (1, None), (2, "x" * 10_000), (3, "x" * 10_001), (4, "  hi\x00 there \n"), (5, " " * 10_001)]
    got = {r["k"]: r for r in bs.read_freetext(spark.createDataFrame(rows, "k int, text string"), keep=("k",)).collect()}
    assert got[0]["text"] == "hi there"
    assert got[0]["source_metadata"]["source_id"].startswith("freetext_")
    assert got[0]["source_metadata"]["source_id"] == got[4]["source_metadata"]["source_id"]
    assert got[0]["source_metadata"]["raw_text_length"] == 8
    assert got[1]["reject_reason"] == "Source must be a string"
    assert got[2]["reject_reason"] is None
    assert got[3]["reject_reason"] == got[5]["reject_reason"] == "Text length (10001) exceeds maximum (10000)"
    with pytest.raises(ValueError):
        bs.read_freetext(spark.createDataFrame([(1,)], "text int"))


def test_read_ado(spark):
    full = {
        "System.Title": "T <b>x</b>", "System.Description": "D&nbsp;1",
        "Microsoft.VSTS.TCM.ReproSteps": "1. a\n2. b", "Microsoft.VSTS.Common.AcceptanceCriteria": "C",
        "System.State": "Active",
    }
    items = [
        json.dumps({"id": "7", "fields": full}), json.dumps({"id": 8, "fields": {"System.Title": "", "System.Description": "only"}}),
        json.dumps({"fields": {"System.Title": "t"}}), json.dumps({"id": None, "fields": {}}), json.dumps({"id": 9}),
        "[1]", "\"text\"", "{broken", None, json.dumps({"id": 10, "fields": {"System.Title": {"a": 1}}}),
    ]
    df = spark.createDataFrame(list(enumerate(items)), "k int, json string")
    got = {r["k"]: r for r in bs.read_ado(df, keep=("k",)).collect()}
    assert got[0]["text"] == (
        "Title: T x\n\nDescription: D 1\n\nReproduction Steps: 1. a\n2. b\n\nExpected Behavior: C"
    )
    ids = {k: r["source_metadata"]["source_id"] for k, r in got.items()}
    assert [ids[k] for k in (0, 1, 2, 3, 4)] == ["ado_7", "ado_8", "ado_unknown", "ado_None", "ado_9"]
    assert got[1]["text"] == "Description: only"
    assert got[2]["source_metadata"]["ado_work_item_id"] == "unknown"
    assert got[3]["text"] == got[4]["text"] == ""
    for k in (5, 6, 7, 8):
        assert got[k]["reject_reason"] == "ADO source must be a dictionary", items[k]
    assert got[9]["text"] == 'Title: {"a":1}'


def test_union_and_custom_source(spark):
    custom = spark.createDataFrame([("NPE", ("freetext", "mine"))], "text string, source_metadata struct<source_type:string,source_id:string>")
    free = bs.read_freetext(spark.createDataFrame([("a",)], "text string"))
    both = bs.union_sources(custom, free)
    assert both.columns == STAGING.fieldNames() and both.count() == 2
    assert both.where("source_metadata.source_id = 'mine'").first()["source_metadata"]["raw_text_length"] == 3
    with pytest.raises(ValueError):
        bs.as_staging(spark.createDataFrame([("a",)], "text string"))
    with pytest.raises(ValueError):
        bs.union_sources()


def test_spread(spark, small):
    scan = spark.read.parquet(f"{small}/events.parquet")
    assert bs.spread(scan, 6).rdd.getNumPartitions() == 6
    assert bs.spread(scan) is scan


NAMES = ["50% done", "a%41b", "a+b", "a b", "ünï", "%", "%zz", "x#y", "q?r"]


def test_odd_file_names(spark, tmp_path):
    for n in NAMES:
        (tmp_path / f"{n}.log").write_text("NPE")
        (tmp_path / f"{n}.pdf").write_bytes(b"%PDF")
        (tmp_path / f"{n} empty.txt").write_bytes(b"")
        (tmp_path / f"{n} big.log").write_bytes(b"x" * 3000)
    logs = by_name(bs.read_error_logs(spark, str(tmp_path), max_mb=0.002))
    assert set(logs) == {f"{n}{end}" for n in NAMES for end in (".log", " empty.txt", " big.log")}
    assert all((r["reject_reason"] is not None) == name.endswith(" big.log") for name, r in logs.items())
    assert all(logs[f"{n} empty.txt"]["text"] == "" for n in NAMES)
    assert set(by_name(bs.read_binary_docs(spark, str(tmp_path)))) == {f"{n}.pdf" for n in NAMES}
    asked = spark.createDataFrame([(str(tmp_path / f"{n}.log"),) for n in NAMES], "path string")
    assert bs.missing_files(asked, bs.read_error_logs(spark, str(tmp_path))).count() == 0


def test_read_folder_accounts_for_every_file(spark, folder):
    (folder / "sub").mkdir()
    (folder / "sub" / "deep.log").write_text("NPE")
    got = by_name(bs.read_folder(spark, str(folder), max_mb=1, recursive=True))
    assert set(got) == {p.name for p in folder.rglob("*") if p.is_file()}
    assert got["skip.csv"]["reject_reason"] == "Unsupported file type: .csv"
    assert got["doc.pdf"]["reject_reason"] is None and got["deep.log"]["text"] == "NPE"
    assert "deep.log" not in by_name(bs.read_folder(spark, str(folder)))


def test_rejects_of_a_stream(spark, folder, tmp_path):
    good, bad = bs.normalize_stream(
        spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ckpt"), max_mb=1, rejects_out=str(tmp_path / "bad")
    )
    good.awaitTermination()
    bad.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4  # the empty file too
    (r,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert r["reject_reason"] == "File size (1.00 MB) exceeds maximum allowed (1 MB)"
