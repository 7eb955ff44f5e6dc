import random

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.schema import FIELDS
from tests.test_records import FULL, LOG


def test_the_stream_ends_where_the_batch_does(spark, tmp_path):
    rng = random.Random(7)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]), rng.choice([FULL, LOG, "NPE", "quiet"]), i) for i in range(90)]
    rows.append(("once", "NPE", 0))
    meta = F.struct(F.lit("freetext").alias("source_type"), F.lit("s").alias("source_id")).alias("source_metadata")

    def held(frame):
        columns = ["incident", "records", *[f"{f}.value" for f in FIELDS], *[f"{f}.confidence" for f in FIELDS], "overall_confidence"]
        return sorted(map(str, frame.select(columns).collect()))

    def records(frame):
        return bs.normalize(frame.select("text", meta, "incident"), id_mode="content", keep=["incident"])

    for step in range(3):
        part = [r for r in rows if r[2] % 3 == step]
        spark.createDataFrame(part, "incident string, text string, n int").write.mode("append").parquet(src)
        stream = spark.readStream.schema("incident string, text string, n int").parquet(src)
        bs.merge_stream(records(stream), "incident", out, str(tmp_path / "ckpt")).awaitTermination()
        batch = bs.merge_evidence(records(spark.read.parquet(src)), "incident")
        assert held(bs.merged_incidents(spark, out, "incident")) == held(batch)
    quiet = {r.incident for r in bs.merged_incidents(spark, out, "incident", quiet_for=2).collect()}
    assert "once" in quiet and "hot" not in quiet
    bs.compact(spark, out, "incident", str(tmp_path / "new"))
    assert held(bs.merged_incidents(spark, str(tmp_path / "new"), "incident")) == held(batch)
    with pytest.raises(ValueError):
        bs.compact(spark, out, "incident", out + "/")
