"""Records from a growing folder, and monitoring per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bugsieve.operators.reports import monitoring_aggregates
from bugsieve.plans.normalize import normalize
from bugsieve.sinks.records import JSON_OPTIONS
from bugsieve.sources.files import (
    LOG_GLOB,
    MAX_FILE_MB,
    _file_staging,
    log_text,
    too_large,
)
from bugsieve.sources.scratch import scratch_dir
from bugsieve.sources.staging import rejects
from bugsieve.streaming.log_folder import register


def read_log_stream(
    spark: SparkSession, path: str, pattern: str = LOG_GLOB, max_mb: float = MAX_FILE_MB,
    max_files_per_trigger: int | None = None, partitions: int | None = None,
    ledger: str | None = None, recursive: bool = False,
) -> DataFrame:
    """Staging frame of a folder that log files are added to: one row for every file.

    Files of zero bytes give an empty text; files over the size limit give a row with a reject
    reason and are not opened, as do files that vanish between listing and reading. ``normalize``
    leaves rejects out, ``normalize_stream`` writes them to a folder of their own. The stream's own
    source (``log_folder``) keeps the files it has taken in as batches in the folder ``ledger``,
    which belongs to one query, as its checkpoint does; a query that is started again needs the
    same one. ``partitions`` redistributes each micro-batch, for streams of few files at a time.
    """
    register(spark)
    limit = int(max_mb * 1024 * 1024)
    reader = (
        spark.readStream.format("log_folder").option("pattern", pattern).option("maxBytes", limit)
        .option("recursive", recursive).option("ledger", ledger or scratch_dir(spark, "ledger"))
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(path)
    size, read = F.col("size"), F.col("content").isNotNull()
    files = files.select(
        F.when(read, log_text(F.col("content").cast("string"))).alias("text"), "path", "size",
        F.when(~read, F.coalesce(too_large(size, max_mb), F.concat(F.lit("File not found: "), "path")))
        .alias("reject_reason"),
    )
    return _file_staging(files.repartition(partitions) if partitions else files)


def write_stream(
    bugs: DataFrame, out: str, checkpoint: str, format: str = "parquet", available_now: bool = True
) -> StreamingQuery:
    """Append records to a file sink; the checkpoint makes each input count exactly once."""
    writer = (
        bugs.writeStream.format(format)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if format == "json":
        writer = writer.options(**JSON_OPTIONS)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def normalize_stream(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    *,
    pattern: str = LOG_GLOB,
    max_mb: float = MAX_FILE_MB,
    partitions: int | None = None,
    format: str = "parquet",
    available_now: bool = True,
    rejects_out: str | None = None,
    **options,
) -> StreamingQuery | tuple[StreamingQuery, StreamingQuery]:
    """Normalize every log file that arrives in a folder. Ids follow the content by default.

    ``rejects_out`` is a folder for the rejected files; a second query, with a checkpoint next
    to the first one's, writes there, and both queries are returned.
    """
    options.setdefault("id_mode", "content")
    base = checkpoint.rstrip("/")
    staging = read_log_stream(spark, path, pattern, max_mb, partitions=partitions, ledger=f"{base}-ledger")
    good = write_stream(normalize(staging, **options), out, checkpoint, format, available_now)
    if rejects_out is None:
        return good
    bad = rejects(read_log_stream(spark, path, pattern, max_mb, ledger=f"{base}-rejects-ledger"))
    return good, write_stream(bad, rejects_out, f"{base}-rejects", format, available_now)


def windowed_monitoring(
    bugs: DataFrame,
    time_col: str = "processing_timestamp",
    window: str = "1 hour",
    lateness: str = "10 minutes",
) -> DataFrame:
    """Monitoring metrics per tumbling window; rows later than ``lateness`` are dropped.

    State is one row of sums per open window. Windows whose records were not enriched have no
    enrichment rate.
    """
    return (
        bugs.withWatermark(time_col, lateness)
        .groupBy(F.window(time_col, window).alias("w"))
        .agg(*monitoring_aggregates())
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "records", "mean_overall_confidence", "mean_fields_by_rules",
            "low_confidence_rate", "enrichment_success_rate",
        )
    )


def windowed_quantiles(
    bugs: DataFrame,
    time_col: str = "processing_timestamp",
    window: str = "1 hour",
    lateness: str = "10 minutes",
    shares: tuple[float, ...] = (0.05, 0.5, 0.95),
    accuracy: int = 10_000,
) -> DataFrame:
    """Quantiles of the overall confidence per tumbling window, as columns ``p5``, ``p50``, ``p95``.

    State is one mergeable sketch per open window, whose ranks are off by 1 / ``accuracy`` of its
    records at most. Also for batch frames.
    """
    found = F.percentile_approx("overall_confidence", list(shares), accuracy)
    return (
        bugs.withWatermark(time_col, lateness)
        .groupBy(F.window(time_col, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("records"), found.alias("q"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "records",
            *[F.col("q")[i].alias(f"p{100 * s:g}") for i, s in enumerate(shares)],
        )
    )
