"""Processing times from the progress of streaming queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Target and alert bound of the 95th percentile, in milliseconds a record.
TARGET_MS, ALERT_MS = 2_000.0, 5_000.0

_ROWS = "run_id string, batch long, started timestamp, records long, batch_ms long, rows_dropped long"


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(run_id, batch, started, records, batch_ms, rows_dropped): the batches that a query still
    remembers (``spark.sql.streaming.numRecentProgressUpdates`` of them); rows_dropped counts those
    that came behind the watermark."""
    rows = []
    for p in query.recentProgress:
        p = p if isinstance(p, dict) else json.loads(p.json)
        spent = p.get("batchDuration", p.get("durationMs", {}).get("triggerExecution", 0))
        dropped = sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
        rows.append((p["runId"], int(p["batchId"]), p["timestamp"], int(p.get("numInputRows", 0)), int(spent), int(dropped)))
    text = _ROWS.replace("started timestamp", "started string")
    return spark.createDataFrame(rows, text).withColumn("started", F.col("started").cast("timestamp"))


def processing_time(progress: DataFrame, share: float = 0.95) -> DataFrame:
    """One row (records, metric, value, target, alert_bound, on_target, alert), as ``monitoring_metrics``
    gives them: the exact percentile of the milliseconds that a record of its batch took on average,
    each batch counted by its records. Batches without records take no part."""
    found = progress.where("records > 0").withColumn("ms", F.col("batch_ms") / F.col("records")).agg(
        F.sum("records").alias("records"), F.expr(f"percentile(ms, {share}, records)").alias("value")
    )
    value = F.col("value")
    return found.select(
        F.coalesce("records", F.lit(0)).alias("records"), F.lit(f"processing_time_ms_p{round(100 * share)}").alias("metric"), "value",
        F.lit(TARGET_MS).alias("target"), F.lit(ALERT_MS).alias("alert_bound"),
        F.coalesce(value < TARGET_MS, F.lit(False)).alias("on_target"), F.coalesce(value > ALERT_MS, F.lit(False)).alias("alert"),
    )
