"""The staging frame: text, source metadata, reject reason."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.schema import METADATA, SOURCE_TYPES, STAGING


def metadata(
    source_type: str,
    source_id: Column,
    text: Column,
    file_name: Column | None = None,
    file_size: Column | None = None,
    work_item_id: Column | None = None,
) -> Column:
    """The metadata struct of one text."""
    if source_type not in SOURCE_TYPES:
        raise ValueError(f"unknown source type {source_type!r}")
    none = F.lit(None)
    values = {
        "source_type": F.lit(source_type),
        "source_id": source_id,
        "ingestion_timestamp": F.current_timestamp(),
        "file_name": none if file_name is None else file_name,
        "file_size_bytes": none if file_size is None else file_size,
        "ado_work_item_id": none if work_item_id is None else work_item_id,
        "raw_text_length": F.length(text),
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in METADATA])


def as_staging(df: DataFrame) -> DataFrame:
    """Check a caller's frame and bring it to the staging schema.

    Any frame with ``text`` and ``source_metadata`` is a source; other columns are kept after
    the staging columns.
    """
    missing = {"text", "source_metadata"} - set(df.columns)
    if missing:
        raise ValueError(f"a staging frame needs the columns {sorted(missing)}")
    have = set(df.schema["source_metadata"].dataType.fieldNames())
    lacking = {"source_type", "source_id"} - have
    if lacking:
        raise ValueError(f"source_metadata needs {sorted(lacking)}")
    parts = []
    for f in METADATA:
        if f.name in have:
            value = F.col(f"source_metadata.{f.name}")
        elif f.name == "raw_text_length":
            value = F.length("text")
        elif f.name == "ingestion_timestamp":
            value = F.current_timestamp()
        else:
            value = F.lit(None)
        parts.append(value.cast(f.dataType).alias(f.name))
    reason = F.col("reject_reason") if "reject_reason" in df.columns else F.lit(None)
    extra = [c for c in df.columns if c not in STAGING.fieldNames()]
    return df.select(
        F.col("text").cast("string").alias("text"),
        F.struct(*parts).alias("source_metadata"),
        reason.cast("string").alias("reject_reason"),
        *[F.col(f"`{c}`") for c in extra],
    )


def union_sources(*staging: DataFrame) -> DataFrame:
    """One staging frame from several; extra columns missing in one become NULL."""
    if not staging:
        raise ValueError("union_sources needs at least one frame")
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_staging(s) for s in staging]
    )


def split_rejects(staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects. One bad input never fails a job.

    Both are filters over the same frame; store it first if reading it twice is too dear.
    """
    good = staging.where(F.col("reject_reason").isNull())
    bad = staging.where(F.col("reject_reason").isNotNull())
    return good, rejects(bad)


def rejects(staging: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The dead-letter rows of a staging frame."""
    return staging.where(F.col("reject_reason").isNotNull()).select(
        F.col("source_metadata.source_type").alias("source_type"),
        F.col("source_metadata.source_id").alias("source_id"),
        F.col("source_metadata.file_name").alias("file_name"),
        "reject_reason",
        *keep,
    )
