import shutil

import pytest
from pyspark.sql import functions as F

import bugsieve as bs


def staging(spark, *rows):
    frame = spark.createDataFrame(list(rows), "id string, text string, reason string")
    meta = F.struct(F.lit("freetext").alias("source_type"), F.col("id").alias("source_id"))
    return frame.select("text", meta.alias("source_metadata"), F.col("reason").alias("reject_reason"))


def held(spark, out):
    return sorted((r.batch, r.source_metadata.source_id, r.error_type.value) for r in bs.read_batches(spark, out).collect())


def test_the_same_input_twice_adds_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    assert held(spark, out) == []
    first = [("a", "NPE", None), ("b", "SQLException", None), ("a", "NPE", None), ("c", None, "too large")]
    assert bs.append_new(staging(spark, *first), out, "1").count() == 2
    want = [("1", "a", "NPE"), ("1", "b", "SQLException")]
    assert held(spark, out) == want
    assert bs.append_new(staging(spark, *first), out, "2").count() == 0
    assert held(spark, out) == want
    more = [*first, ("a", "NPE again", None), ("d", "NPE", None), ("c", "now small: NPE", None)]
    assert bs.append_new(staging(spark, *more), out, "3").count() == 3
    want += [("3", "a", "NPE"), ("3", "c", "NPE"), ("3", "d", "NPE")]
    assert held(spark, out) == want
    assert bs.append_new(staging(spark), out, "4").count() == 0
    assert held(spark, out) == want


def test_a_batch_that_failed_or_runs_again_replaces_itself(spark, tmp_path):
    out = tmp_path / "out"
    rows = [("a", "NPE", None), ("b", "SQLException", None)]
    bs.append_new(staging(spark, rows[0]), str(out), "1")
    bs.append_new(staging(spark, *rows), str(out), "2")
    want = [("1", "a", "NPE"), ("2", "b", "SQLException")]
    bs.append_new(staging(spark, *rows), str(out), "2")
    assert held(spark, str(out)) == want
    shutil.rmtree(out / "ids" / "batch=2")  # it fell between records and ids
    assert held(spark, str(out)) == want[:1]
    assert bs.append_new(staging(spark, *rows), str(out), "3").count() == 1
    bs.append_new(staging(spark, *rows), str(out), "2")
    assert held(spark, str(out)) == [("1", "a", "NPE"), ("3", "b", "SQLException")]
    with pytest.raises(ValueError):
        bs.append_new(staging(spark, *rows), str(out), "2/3")


def test_ids_are_joined_without_texts(spark, tmp_path):
    out = str(tmp_path / "out")
    bs.append_new(staging(spark, ("a", "NPE", None)), out, "1")
    plan = bs.new_rows(staging(spark, ("a", "NPE", None)), bs.processed_ids(spark, out))._jdf.queryExecution().optimizedPlan().toString()
    # Below the semi-join, only ids meet; the texts join what is left of them.
    assert 0 <= plan.index("Join LeftSemi") < plan.index("Join LeftAnti")
    assert "Aggregate [content_id" in plan[plan.index("Join LeftSemi"):plan.index("Join LeftAnti")]
