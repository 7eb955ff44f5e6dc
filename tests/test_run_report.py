"""Reports counted by the tasks that write, against the same reports over the records."""

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from checks import corpus


@pytest.mark.parametrize("rows", [None, 0])
def test_reports_equal_those_of_another_pass(spark, small, tmp_path, rows):
    staging = bs.read_ado(corpus.work_items(spark, small))
    staging = staging if rows is None else staging.limit(rows)
    report = bs.RunReport()
    bugs = report.records(bs.normalize(report.inputs(staging), enable_enrichment=True, id_mode="content"))
    bs.write_bugs(bugs, str(tmp_path / "out"), format="parquet")
    good, bad = bs.split_rejects(staging)
    written = spark.read.schema(bugs.schema).parquet(str(tmp_path / "out"))
    assert written.count() == good.count()

    def same(a, b):
        rounded = [[(c, round(v, 9) if isinstance(v, float) else v) for c, v in r.asDict().items()] for r in a.collect()]
        assert rounded == [[(c, round(v, 9) if isinstance(v, float) else v) for c, v in r.asDict().items()] for r in b.collect()]

    same(report.batch_stats(), bs.batch_stats(written))
    same(report.run_stats(), bs.run_stats(written, bad))
    same(report.field_extraction_rate().na.fill(0), bs.field_extraction_rate(written).na.fill(0))
    same(report.field_quality_distribution(), bs.field_quality_distribution(written))
    same(report.monitoring_metrics(), bs.monitoring_metrics(written))


def test_one_scan_writes_and_counts(spark, small):
    report = bs.RunReport()
    items = corpus.table(spark, small, "orders").select(F.concat(F.lit("NPE of order "), "o_orderkey").alias("text"))
    source = items.select("text", F.struct(F.lit("freetext").alias("source_type"), F.lit("x").alias("source_id")).alias("source_metadata"))
    bugs = report.records(bs.normalize(report.inputs(source)))
    plan = bugs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan and plan.count("CollectMetrics") == 2
    bugs.write.format("noop").mode("overwrite").save()
    stats = report.run_stats()
    assert "Scan" not in stats._jdf.queryExecution().executedPlan().toString().replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
    assert stats.first().succeeded == items.count()


def test_nothing_watched():
    with pytest.raises(ValueError):
        bs.RunReport().run_stats()
