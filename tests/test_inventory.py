"""Inventory by tasks and the streaming source, against the folders themselves."""

import os
import re

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.sources.inventory import glob_regex
from bugsieve.streaming.log_folder import FolderReader


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "in put"
    for folder in ("", "day=1", "day=2", "day=2/hour=3", "plain", "plain/deep", "_temporary", ".hidden", "_kept=1"):
        (root / folder).mkdir(parents=True, exist_ok=True)
        for name, data in (("a.log", b"one\n"), ("b.TXT", b""), ("c 100%.log", b"x" * 3_000), ("d.csv", b"1"), ("_e.log", b"no"), (".f.log", b"no")):
            (root / folder / name).write_bytes(data)
    return root


def paths(frame):
    return sorted(r.path for r in frame.select("path").collect())


def walked(root, folders):
    return sorted(
        str(root / f / n) if f else str(root / n)
        for f in folders for n in ("a.log", "b.TXT", "c 100%.log", "d.csv")
    )


def test_inventory_is_what_the_folders_hold(spark, tree):
    tables = ["", "day=1", "day=2", "day=2/hour=3", "_kept=1"]
    assert paths(bs.inventory(spark, str(tree))) == walked(tree, tables)
    everything = bs.inventory(spark, str(tree), recursive=True)
    assert paths(everything) == walked(tree, [*tables, "plain", "plain/deep"])
    for r in everything.collect():
        assert r.size == os.path.getsize(r.path)
        assert abs(r.modified.timestamp() - os.path.getmtime(r.path)) < 1e-3
    assert paths(bs.inventory(spark, f"{tree}/{{day=*,plain}}/*.{{log,TXT}}")) == sorted(
        str(tree / f / n) for f in ("day=1", "day=2", "plain") for n in ("a.log", "b.TXT", "c 100%.log")
    )
    assert paths(bs.inventory(spark, [str(tree / "day=1"), str(tree / "plain")], "*.[lL]og")) == sorted(
        str(tree / f / n) for f in ("day=1", "plain") for n in ("a.log", "c 100%.log")
    )
    assert paths(bs.inventory(spark, str(tree / "gone"))) == []
    assert paths(bs.inventory(spark, str(tree / "day=1" / "a.log"))) == [str(tree / "day=1" / "a.log")]


def test_names_do_not_pass_the_driver(spark, tree):
    staging = bs.read_error_logs(spark, str(tree), max_mb=0.002, recursive=True)
    plan = staging._jdf.queryExecution().logical().toString()
    assert "LocalRelation" not in plan and "b.TXT" not in plan
    got = {r.source_metadata.source_id: r for r in staging.collect()}
    empty = {p for p, r in got.items() if r.source_metadata.file_size_bytes == 0}
    assert empty == {str(tree / f / "b.TXT") for f in ("", "day=1", "day=2", "day=2/hour=3", "_kept=1", "plain", "plain/deep")}


def test_globs():
    for pattern, yes, no in (
        ("*.{log,txt}", ["a.log", ".txt"], ["a.LOG", "alog", "a.log2"]),
        ("*.{[lL][oO][gG],[tT][xX][tT]}", ["a.LoG", "b.TXT"], ["a.pdf"]),
        ("part-?[!0]*", ["part-01x", "part-x9"], ["part-00", "part-"]),
        ("a+b(1).log", ["a+b(1).log"], ["aab1.log", "a+b(1)xlog"]),
        ("x[", ["x["], ["x"]),
        ("\\*", ["*"], ["a"]),
    ):
        regex = re.compile(glob_regex(pattern))
        assert all(regex.fullmatch(n) for n in yes) and not any(regex.fullmatch(n) for n in no), pattern


def test_check_paths(spark, tree):
    asked = [
        (1, str(tree / "a.log")), (2, f"file://{tree}/day=1/a.log"), (3, str(tree / "gone.log")),
        (4, str(tree / "nowhere" / "a.log")), (5, str(tree / "d.csv")), (6, str(tree / "plain" / "c 100%.log")), (7, None), (1, str(tree / "a.log")),
    ]
    frame = spark.createDataFrame(asked, "n int, path string").withColumn("length", F.lit("other"))
    got = sorted(((r.n, r.length, (r.reject_reason or "").split(":")[0]) for r in bs.check_paths(frame, max_mb=0.002).collect()))
    assert got == [
        (1, 4, ""), (1, 4, ""), (2, 4, ""), (3, None, "File not found"), (4, None, "File not found"),
        (5, 1, "Unsupported file type"), (6, 3_000, "File size (0.00 MB) exceeds maximum allowed (0.002 MB)"), (7, None, ""),
    ]


def test_a_stream_accounts_for_every_file_once(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    (root / "day=1").mkdir(parents=True)

    def put(name, data):
        (root / name).write_bytes(data)

    def step():
        staging = bs.read_log_stream(spark, str(root), ledger=str(tmp_path / "ledger"), max_mb=0.002)
        rows = staging.select("text", F.col("source_metadata.source_id").alias("path"),
                              F.col("source_metadata.file_size_bytes").alias("size"), "reject_reason")
        bs.write_stream(rows, out, str(tmp_path / "ckpt")).awaitTermination()
        return sorted((os.path.relpath(r.path, root), r.text, r.size) for r in spark.read.parquet(out).collect())

    put("a.log", b"one\r\ntwo")
    put("day=1/empty.TXT", b"")
    put("skip.csv", b"x")
    put("_part.log", b"x")
    want = [("a.log", "one\ntwo", 8), ("day=1/empty.TXT", "", 0)]
    assert step() == want
    assert step() == want  # nothing new
    put("late.log", b"caf\xc3\xa9 \xff")
    os.utime(root / "late.log", (1, 1))  # an old time is no reason to miss it
    put("big.log", b"x" * 3_000)
    want += [("big.log", None, 3_000), ("late.log", "café ", 7)]
    assert step() == sorted(want, key=str)
    put("a.log", b"changed")  # another size: another file
    assert step() == sorted([*want, ("a.log", "changed", 7)], key=str)


def test_batches_outlive_the_reader(tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    options = {"path": str(root), "ledger": str(tmp_path / "ledger"), "pattern": "*.log", "maxbytes": "100", "maxfilespertrigger": "2"}
    for n in "abc":
        (root / f"{n}.log").write_text(n)
        os.utime(root / f"{n}.log", (ord(n), ord(n)))
    first = FolderReader(options)
    assert first.latestOffset() == {"batch": 1}
    again = FolderReader(options)  # the first one fell before its offset was known
    assert again.latestOffset() == {"batch": 2} == again.latestOffset()
    entries = [e for p in again.partitions({"batch": 0}, {"batch": 2}) for e in p.entries]
    assert [os.path.basename(e[0]) for e in entries] == ["a.log", "b.log", "c.log"]
    assert [e for p in first.partitions({"batch": 1}, {"batch": 2}) for e in p.entries] == entries[2:]
    assert again.partitions({"batch": 2}, {"batch": 2}) == []
    (part,) = again.partitions({"batch": 0}, {"batch": 2})
    (root / "b.log").unlink()
    (batch,) = again.read(part)
    assert batch.column("content").to_pylist() == [b"a", None, b"c"]
    assert batch.column("size").to_pylist() == [1, None, 1]
