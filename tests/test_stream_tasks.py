"""The files of a stream are dealt to tasks in any order, those first that cost a task nothing too."""

import os

import pytest

from bugsieve.sources.files import LOG_GLOB
from bugsieve.streaming import log_folder
from bugsieve.streaming.log_folder import FolderReader
from bugsieve.streaming.normalize_stream import read_log_stream


def write(folder, sizes):
    """Files of these sizes, the first the oldest."""
    folder.mkdir()
    for i, size in enumerate(sizes):
        (folder / f"{i}.log").write_bytes(b"x" * size)
        os.utime(folder / f"{i}.log", (1_000_000 + i, 1_000_000 + i))


@pytest.mark.parametrize(
    "sizes, tasks",
    [([0], [1]), ([500], [1]), ([0, 500, 60, 60, 0], [3, 2]), ([500, 0, 100], [3]), ([90, 90, 0, 90], [1, 2, 1]), ([], [])],
)
def test_each_file_is_in_one_task(tmp_path, monkeypatch, sizes, tasks):
    monkeypatch.setattr(log_folder, "TASK_BYTES", 100)
    write(tmp_path / "in", sizes)
    reader = FolderReader({"path": str(tmp_path / "in"), "ledger": str(tmp_path / "ledger"), "pattern": LOG_GLOB, "maxbytes": "100"})
    made = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [len(p.entries) for p in made] == tasks
    assert [e[1] for p in made for e in p.entries] == sizes


@pytest.mark.parametrize("sizes", [[0, 9], [3000, 9, 0]])
def test_a_stream_may_begin_with_an_empty_or_a_too_large_file(spark, tmp_path, sizes):
    write(tmp_path / "in", sizes)
    files = read_log_stream(spark, str(tmp_path / "in"), max_mb=0.001, ledger=str(tmp_path / "ledger"))
    query = (
        files.selectExpr("source_metadata.file_size_bytes AS size", "length(text) AS length").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(s, s if s < 1000 else None) for s in sizes}
