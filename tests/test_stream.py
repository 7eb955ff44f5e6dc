import datetime as dt

from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.schema import FIELDS
from tests.test_records import FULL, LOG


def test_stream_equals_batch(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    (src / "a.log").write_text(LOG)
    (src / "b.txt").write_text(FULL)
    (src / "skip.md").write_text("NPE")

    def step():
        bs.normalize_stream(spark, str(src), str(out), str(ckpt)).awaitTermination()
        return spark.read.parquet(str(out))

    assert step().count() == 2
    (src / "c.LOG").write_text("NPE NPE")
    got = step()
    assert got.count() == 3
    cols = ["bug_id", "source_metadata.source_id", *[f"{f}.value" for f in FIELDS], "overall_confidence"]
    batch = bs.normalize(bs.read_error_logs(spark, str(src)), id_mode="content")
    assert sorted(got.select(cols).collect()) == sorted(batch.select(cols).collect())


def test_windows_drop_late_rows(spark, tmp_path):
    src = tmp_path / "in"
    start = dt.datetime(2024, 1, 1, 10, 0)

    def add(minutes, text):
        rows = [(start + dt.timedelta(minutes=m), text) for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, text string").coalesce(1).write.mode("append").parquet(str(src))

    def run():
        stream = spark.readStream.schema("ts timestamp, text string").parquet(str(src))
        staging = stream.select(
            "text", F.struct(F.lit("freetext").alias("source_type"), F.lit("s").alias("source_id")).alias("source_metadata"), "ts"
        )
        bugs = bs.normalize(staging, id_mode="content", keep=["ts"])
        windows = bs.windowed_monitoring(bugs, "ts", "10 minutes", "5 minutes")
        bs.write_stream(windows, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return {r["window_start"].minute: (r["records"], r["mean_fields_by_rules"]) for r in rows}

    add([1, 2, 30], "NPE")
    assert run() == {0: (2, 1.0)}
    add([3, 31, 50], "nothing")
    # The row of minute 3 came after its window was closed.
    assert run() == {0: (2, 1.0), 30: (2, 0.5)}
