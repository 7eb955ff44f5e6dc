"""Write records as JSON lines or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_json(bugs: DataFrame) -> DataFrame:
    """One JSON object per record, every key present."""
    return bugs.select(F.to_json(F.struct(*bugs.columns), JSON_OPTIONS).alias("value"))


def write_bugs(
    bugs: DataFrame,
    path: str,
    format: str = "json",
    mode: str = "errorifexists",
    by_source_type: bool = False,
) -> None:
    """Write all records in parallel; optionally one folder per source type."""
    if format not in ("json", "parquet"):
        raise ValueError("format must be 'json' or 'parquet'")
    if by_source_type:
        bugs = bugs.withColumn("source_type", F.col("source_metadata.source_type"))
    writer = bugs.write.mode(mode)
    if format == "json":
        writer = writer.options(**JSON_OPTIONS)
    if by_source_type:
        writer = writer.partitionBy("source_type")
    writer.format(format).save(path)
