"""One record per incident over a stream: each batch is merged, and the batches' results are."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bugsieve.operators.combine import merge_in_one_pass, merge_merged


def merge_stream(
    bugs: DataFrame, key: str, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Start a query that merges the records of each batch by ``key`` and adds the result to ``out``.

    A batch writes the folder ``parts/batch=...`` of its own, so that one that is run again replaces
    itself. No state is held in memory: an incident whose records come in many batches has a row in
    each part, and ``merged_incidents`` merges those rows. ``compact`` joins old parts to one.
    """

    def batch(rows: DataFrame, n: int) -> None:
        merge_in_one_pass(rows, key).write.mode("overwrite").parquet(f"{out}/parts/batch={n}")

    writer = bugs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def merged_incidents(spark: SparkSession, out: str, key: str, quiet_for: int | None = None) -> DataFrame:
    """The rows that ``merge_evidence`` would give over all records so far, upserts applied.

    ``quiet_for`` gives only incidents without a record in so many last batches: those that have
    come to rest. Records without a key stay rows of their own.
    """
    parts = spark.read.parquet(f"{out}/parts").withColumn("batch", F.col("batch").cast("long"))
    merged = merge_merged(parts.drop("batch"), key)
    if quiet_for is None:
        return merged
    last = parts.agg(F.max("batch")).first()[0]
    awake = parts.where(F.col("batch") > last - quiet_for).select(key).distinct()
    return merged.join(awake, key, "left_anti")


def compact(spark: SparkSession, out: str, key: str, to: str) -> None:
    """Write the merged rows as the first part of a new folder ``to``, for a stream that goes on there
    under the same checkpoint; the old folder stays as it is."""
    if re.sub("/+$", "", out) == re.sub("/+$", "", to):
        raise ValueError("parts are compacted into another folder")
    parts = spark.read.parquet(f"{out}/parts")
    last = parts.agg(F.max(F.col("batch").cast("long"))).first()[0]
    merge_merged(parts.drop("batch"), key).drop("overall_confidence").write.mode("overwrite").parquet(f"{to}/parts/batch={last}")
