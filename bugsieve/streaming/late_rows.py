"""Windowed monitoring that loses no row: late ones go to a table of their own."""

from __future__ import annotations

import json

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bugsieve.functions import scoring
from bugsieve.sources.inventory import storage

_MARK = "_window"
_PARTIAL = (
    "window_start timestamp, window_end timestamp, records long, confidence double, by_rules double, low long, "
    "applied long, changed long, latest timestamp"
)


def _partial_sums(threshold: float) -> list[Column]:
    overall, applied = F.col("overall_confidence"), F.col("nlp_enrichment_applied")
    return [
        F.count(F.lit(1)).alias("records"),
        F.sum(overall).alias("confidence"),
        F.sum(F.col("fields_extracted_by_regex").cast("double")).alias("by_rules"),
        F.count_if(overall < threshold).alias("low"),
        F.count_if(applied).alias("applied"),
        F.count_if(applied & (F.col("fields_enriched_by_nlp") > 0)).alias("changed"),
        F.max(f"{_MARK}.time").alias("latest"),
    ]


class _Watermark:
    """The latest event time of the batches so far, a small file for each batch."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _open(self) -> tuple[pafs.FileSystem, str]:
        system, inner, _ = storage(self.folder)
        system.create_dir(inner, recursive=True)
        return system, inner

    def before(self, batch: int) -> float | None:
        """Seconds since 1970 of the latest event before a batch; None at first."""
        system, inner = self._open()
        name = f"{inner}/{batch - 1}.json"
        if batch == 0 or system.get_file_info(name).type != pafs.FileType.File:
            return None
        with system.open_input_stream(name) as file:
            return json.loads(file.read())["latest"]

    def put(self, batch: int, latest: float | None) -> None:
        system, inner = self._open()
        with system.open_output_stream(f"{inner}/.{batch}.new") as file:
            file.write(json.dumps({"latest": latest}).encode())
        system.move(f"{inner}/.{batch}.new", f"{inner}/{batch}.json")


def monitor_with_late_rows(
    bugs: DataFrame, out: str, checkpoint: str, time_col: str = "processing_timestamp",
    window: str = "1 hour", lateness: str = "10 minutes", threshold: float = scoring.LEVEL_MEDIUM,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that sums the records of a stream by tumbling window and keeps the late ones.

    A record is late if its window had ended ``lateness`` before the latest event of the batches before
    its own, the rule by which Spark's watermark drops rows. Late records go whole to ``out/late``, the
    others as sums to ``out/partials``, a row per batch and window: kept and late records together are
    those given. Each batch writes folders of its own name, so that one that is run again replaces itself.
    Records without a time are late. ``window_metrics`` and ``late_records`` read the tables.
    """
    marks = _Watermark(f"{out}/watermark")
    seconds = bugs.sparkSession.sql(
        f"SELECT CAST(unix_seconds(timestamp_seconds(0) + INTERVAL {window}) AS BIGINT), "
        f"CAST(unix_seconds(timestamp_seconds(0) + INTERVAL {lateness}) AS BIGINT)"
    ).first()
    width, delay = seconds[0], seconds[1]

    def batch(rows: DataFrame, n: int) -> None:
        spark = rows.sparkSession
        latest = marks.before(n)
        time = F.col(time_col).cast("timestamp")
        start = F.floor(time.cast("double") / width) * width
        late = time.isNull()
        if latest is not None:
            late = late | (start + width <= latest - delay)
        # Kept for two results; a lost part of it is made again from the batch.
        marked = rows.withColumn(_MARK, F.struct(time.alias("time"), start.alias("start"), late.alias("late"))).persist()
        try:
            kept = marked.where(~F.col(f"{_MARK}.late")).groupBy(F.col(f"{_MARK}.start").alias("start"))
            kept.agg(*_partial_sums(threshold)).select(
                F.timestamp_seconds("start").alias("window_start"), F.timestamp_seconds(F.col("start") + width).alias("window_end"),
                "records", "confidence", "by_rules", "low", "applied", "changed", "latest",
            ).write.mode("overwrite").parquet(f"{out}/partials/batch={n}")
            marked.where(f"{_MARK}.late").drop(_MARK).write.mode("overwrite").parquet(f"{out}/late/batch={n}")
        finally:
            marked.unpersist()
        here = spark.read.schema(_PARTIAL).parquet(f"{out}/partials/batch={n}").agg(F.max("latest").cast("double")).first()[0]
        known = [x for x in (latest, here) if x is not None]
        marks.put(n, max(known) if known else None)

    writer = bugs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def window_metrics(spark: SparkSession, out: str, closed_by: str | None = None) -> DataFrame:
    """The metrics of each window, as ``windowed_monitoring`` gives them, from the sums of all batches.

    ``closed_by`` is a lateness: only windows that ended as long before the latest event, to which no
    record can be added any more, are given. None gives the open ones too, as far as they are.
    """
    partials = spark.read.schema(f"{_PARTIAL}, batch long").parquet(f"{out}/partials")
    windows = partials.groupBy("window_start", "window_end").agg(
        *(F.sum(c).alias(c) for c in ("records", "confidence", "by_rules", "low", "applied", "changed"))
    )
    if closed_by is not None:
        latest = partials.agg(F.max("latest").cast("double")).first()[0]
        windows = windows.where(
            F.col("window_end") <= F.timestamp_seconds(F.lit(latest)) - F.expr(f"INTERVAL {closed_by}")
        )
    n = F.col("records")
    return windows.select(
        "window_start", "window_end", "records", (F.col("confidence") / n).alias("mean_overall_confidence"),
        (F.col("by_rules") / n).alias("mean_fields_by_rules"), (F.col("low") / n).alias("low_confidence_rate"),
        (F.col("changed") / F.nullif(F.col("applied"), F.lit(0))).alias("enrichment_success_rate"),
    )


def late_records(spark: SparkSession, out: str) -> DataFrame:
    """The records that came too late, with the number of their ``batch``."""
    return spark.read.parquet(f"{out}/late")
