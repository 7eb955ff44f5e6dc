"""A micro-batch is merged in one pass over its records."""

from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.operators.combine import merge_in_one_pass
from tests.test_records import FULL, LOG

ROWS = [("a", FULL), ("a", LOG), ("b", "NPE"), (None, "NPE"), (None, "NPE"), (None, "quiet"), ("b", "quiet"), ("b", "NPE")]


def meta():
    return F.struct(F.lit("freetext").alias("source_type"), F.lit("s").alias("source_id")).alias("source_metadata")


def test_a_batch_extracts_each_record_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(ROWS, "incident string, text string").write.parquet(src)
    stream = spark.readStream.schema("incident string, text string").parquet(src)
    bugs = bs.normalize(stream.select(counted.asNondeterministic()("text").alias("text"), meta(), "incident"), id_mode="content", keep=["incident"])
    bs.merge_stream(bugs, "incident", out, str(tmp_path / "ckpt")).awaitTermination()
    assert seen.value == len(ROWS)
    assert bs.merged_incidents(spark, out, "incident").count() == 5


def test_one_pass_gives_the_same_rows(spark):
    frame = spark.createDataFrame(ROWS * 3, "incident string, text string").select("text", meta(), "incident")
    bugs = bs.normalize(frame, id_mode="content", keep=["incident"])
    columns = ["incident", "records", "error_type.value", "error_type.confidence", "observed_behavior.value"]
    a, b = (sorted(map(str, f.select(columns).collect())) for f in (bs.merge_evidence(bugs, "incident"), merge_in_one_pass(bugs, "incident")))
    assert a == b and len(a) == 11
