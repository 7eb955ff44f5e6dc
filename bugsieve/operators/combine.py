"""Record-level composition: one record per incident, several reports per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.functions import scoring
from bugsieve.schema import EXTRACTION_SOURCES, FIELDS
from bugsieve.sources.staging import as_staging

_PARTS = ("value", "confidence", "source", "raw_evidence")
SEPARATOR = r"(?m)^={10,}[ \t]*$\n?"


def _source_order(source: Column) -> Column:
    order = F.lit(0.0)
    for name in EXTRACTION_SOURCES:
        order = F.when(source == name, F.lit(scoring.SOURCE_WEIGHTS[name])).otherwise(order)
    return order


def _picks() -> list[Column]:
    """The best of each field, over the rows of a group."""
    return [
        F.max_by(
            F.struct(*[F.col(f"{f}.{part}").alias(part) for part in _PARTS]),
            F.struct(
                F.col(f"{f}.value").isNotNull().cast("int").alias("filled"),
                F.col(f"{f}.confidence").alias("confidence"),
                _source_order(F.col(f"{f}.source")).alias("source_order"),
                F.col(f"{f}.value").alias("value"),
                F.col(f"{f}.raw_evidence").alias("raw_evidence"),
            ),
        ).alias(f)
        for f in FIELDS
    ]


def merge_evidence(bugs: DataFrame, key: str) -> DataFrame:
    """One row per incident: for each field the value with the highest confidence.

    Ties go to the more reliable source, then to the larger value, so the result does not
    depend on row order. ``max_by`` is combined before the shuffle, so an incident with very
    many records sends one row per task. Spark sorts each task's records for that, since the
    picks hold strings; choosing by numbers first would need the extraction, which costs
    several times the sort, or a shuffle of all records a second time. Records without a key belong to no incident: each
    stays a row of its own and is not shuffled.
    """
    return merge_merged(bugs.withColumn("records", F.lit(1).cast("long")), key)


def merge_merged(parts: DataFrame, key: str) -> DataFrame:
    """Rows of ``merge_evidence`` over parts of the records, merged to those over all of them.

    The best of the parts' best is the best of all, so the parts can be merged in any order.
    """
    picks = _picks()
    named = F.col(key).isNotNull()
    merged = parts.where(named).groupBy(key).agg(F.sum("records").alias("records"), *picks)
    alone = parts.where(~named).select(
        key, "records", *[F.struct(*[F.col(f"{f}.{part}").alias(part) for part in _PARTS]).alias(f) for f in FIELDS],
    )
    return merged.unionByName(alone).withColumn("overall_confidence", scoring.overall_confidence())


def merge_in_one_pass(bugs: DataFrame, key: str) -> DataFrame:
    """``merge_evidence``, without ``overall_confidence``, for frames that are computed anew by each use.

    A micro-batch is such a frame: no filter reaches below it, so that taking the records without a
    key apart would extract all records a second time. Here each of them is a group of its own.
    """
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = bugs.withColumns({"records": F.lit(1).cast("long"), "__alone": alone})
    return rows.groupBy(key, "__alone").agg(F.sum("records").alias("records"), *_picks()).drop("__alone")


def split_reports(staging: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """One staging row per report of a text that holds several, divided by ``====`` lines.

    Opt-in: a file is one report unless the caller says otherwise. Blank parts are dropped and
    the part number is added to the source id.
    """
    staging = as_staging(staging)
    other = [c for c in staging.columns if c not in ("text", "source_metadata")]
    parts = staging.select(
        "source_metadata", *other, F.posexplode(F.split("text", separator)).alias("part", "text")
    ).where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    return parts.select(
        "text",
        F.col("source_metadata")
        .withField(
            "source_id",
            F.concat_ws("#", F.col("source_metadata.source_id"), (F.col("part") + 1).cast("string")),
        )
        .withField("raw_text_length", F.length("text").cast("bigint"))
        .alias("source_metadata"),
        *other,
    )
