"""Reports over records. Each aggregate is one pass with partial sums before any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.functions import scoring
from bugsieve.schema import FIELDS

LEVELS = ("high", "medium", "low")
NOT_DETECTED = "[NOT DETECTED]"
SUMMARY_CHARS = 100
SUMMARY_THRESHOLD = 0.6
# Long fields are cut in the summary; type and component are shown whole.
_CUT = ("trigger_repro_steps", "observed_behavior", "expected_behavior")

# Metric, target, alert bound, and whether larger values are better.
MONITORED = (
    ("mean_overall_confidence", 0.70, 0.50, True),
    ("mean_fields_by_rules", 4.0, 3.0, True),
    ("low_confidence_rate", 0.20, 0.40, False),
    ("enrichment_success_rate", 0.90, 0.70, True),
)


def _bands(confidence: Column) -> dict[str, Column]:
    level = scoring.confidence_level(confidence)
    return {name: F.count_if(level == name) for name in LEVELS}


def bug_summary(bugs: DataFrame, threshold: float = SUMMARY_THRESHOLD) -> DataFrame:
    """One flat display row per record."""

    def shown(f: str) -> Column:
        value = F.col(f"{f}.value")
        if f in _CUT:
            value = F.when(
                F.length(value) > SUMMARY_CHARS,
                F.concat(F.left(value, F.lit(SUMMARY_CHARS)), F.lit("...")),
            ).otherwise(value)
        return F.coalesce(value, F.lit(NOT_DETECTED)).alias(f)

    detail = []
    for f in FIELDS:
        filled = F.col(f"{f}.value").isNotNull()
        detail += [
            shown(f),
            F.when(filled, F.col(f"{f}.confidence")).alias(f"{f}_confidence"),
            F.when(filled, F.col(f"{f}.source")).alias(f"{f}_source"),
        ]
    return bugs.select(
        F.coalesce("source_metadata.file_name", "source_metadata.source_id").alias("source_file"),
        "bug_id",
        "overall_confidence",
        F.concat_ws(
            "/", F.col("fields_extracted_by_regex").cast("string"),
            F.col("total_extractable_fields").cast("string"),
        ).alias("fields_extracted"),
        *detail,
        F.array_join(scoring.low_confidence_fields(threshold), ", ").alias("low_confidence_fields"),
    )


def batch_aggregates() -> list[Column]:
    overall = F.col("overall_confidence")
    return [
        F.count(F.lit(1)).alias("total_processed"),
        F.avg(overall).alias("mean_confidence"),
        *[n.alias(f"{name}_confidence") for name, n in _bands(overall).items()],
    ]


def batch_stats(bugs: DataFrame) -> DataFrame:
    """Number of records, mean overall confidence, records per band."""
    return bugs.agg(*batch_aggregates())


def run_stats(bugs: DataFrame, rejects: DataFrame) -> DataFrame:
    """Succeeded and failed inputs, spread of the overall confidence, bands with percentages."""
    outcome = bugs.select("overall_confidence").unionByName(
        rejects.select(F.lit(None).cast("double").alias("overall_confidence"))
    )
    overall = F.col("overall_confidence")
    ok = F.count(overall)
    bands = {
        name: F.count_if(overall.isNotNull() & (scoring.confidence_level(overall) == name))
        for name in LEVELS
    }
    return outcome.agg(
        ok.alias("succeeded"),
        F.count_if(overall.isNull()).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.avg(overall).alias("mean_confidence"),
        F.max(overall).alias("max_confidence"),
        F.min(overall).alias("min_confidence"),
        *[n.alias(f"{name}_confidence") for name, n in bands.items()],
        *[(F.lit(100.0) * n / F.nullif(ok, F.lit(0))).alias(f"{name}_pct") for name, n in bands.items()],
    )


def rate_aggregates() -> list[Column]:
    found = F.sum("fields_extracted_by_regex")
    possible = F.sum("total_extractable_fields")
    return [
        found.alias("fields_extracted"),
        possible.alias("fields_possible"),
        (F.lit(100.0) * found / possible).alias("extraction_rate_pct"),
    ]


def field_extraction_rate(bugs: DataFrame) -> DataFrame:
    """Fields filled by rules, out of how many, in percent."""
    return bugs.agg(*rate_aggregates())


def failed_items(rejects: DataFrame) -> DataFrame:
    """Name and error of every rejected input."""
    return rejects.select(
        F.coalesce("file_name", "source_id").alias("item"), F.col("reject_reason").alias("error")
    )


def field_quality_distribution(bugs: DataFrame) -> DataFrame:
    """Share of high, medium and low fields, per field and over all.

    One row of counters is aggregated and then unfolded, so no row per record and field is
    made and levels that do not occur show a zero.
    """
    return quality_shares(bugs.agg(F.count(F.lit(1)).alias("records"), *quality_aggregates()))


def quality_aggregates() -> list[Column]:
    """Counters ``<field>__<level>``."""
    return [n.alias(f"{f}__{name}") for f in FIELDS for name, n in _bands(F.col(f"{f}.confidence")).items()]


def quality_shares(counted: DataFrame) -> DataFrame:
    """The row of ``records`` and counters as a row per field and level."""
    rows = [
        F.struct(
            F.lit(f).alias("field"),
            F.lit(name).alias("level"),
            F.col(f"{f}__{name}").alias("fields"),
            F.col("records").alias("total"),
        )
        for f in FIELDS for name in LEVELS
    ]
    for name in LEVELS:
        over_all = F.lit(0).cast("bigint")
        for f in FIELDS:
            over_all = over_all + F.col(f"{f}__{name}")
        rows.append(
            F.struct(
                F.lit("all").alias("field"),
                F.lit(name).alias("level"),
                over_all.alias("fields"),
                (F.col("records") * len(FIELDS)).alias("total"),
            )
        )
    return counted.select(F.inline(F.array(*rows))).withColumn(
        "share_pct", F.lit(100.0) * F.col("fields") / F.nullif(F.col("total"), F.lit(0))
    )


def monitoring_aggregates(threshold: float = scoring.LEVEL_MEDIUM) -> list[Column]:
    """The four data-derived metrics; also used per window on streams.

    Enrichment succeeds where it was applied and changed at least one field.
    """
    applied = F.col("nlp_enrichment_applied")
    changed = applied & (F.col("fields_enriched_by_nlp") > 0)
    return [
        F.count(F.lit(1)).alias("records"),
        F.avg("overall_confidence").alias("mean_overall_confidence"),
        F.avg(F.col("fields_extracted_by_regex").cast("double")).alias("mean_fields_by_rules"),
        F.avg(F.when(F.col("overall_confidence") < threshold, 1.0).otherwise(0.0)).alias(
            "low_confidence_rate"
        ),
        F.avg(F.when(applied, F.when(changed, 1.0).otherwise(0.0))).alias("enrichment_success_rate"),
    ]


def metric_rows() -> Column:
    rows = []
    for name, target, alert, larger in MONITORED:
        value = F.col(name)
        rows.append(
            F.struct(
                F.lit(name).alias("metric"),
                value.alias("value"),
                F.lit(target).alias("target"),
                F.lit(alert).alias("alert_bound"),
                F.coalesce(value > target if larger else value < target, F.lit(False)).alias("on_target"),
                F.coalesce(value < alert if larger else value > alert, F.lit(False)).alias("alert"),
            )
        )
    return F.inline(F.array(*rows))


def monitoring_metrics(bugs: DataFrame) -> DataFrame:
    """One row per metric: value, target, alert bound, and whether either is crossed.

    Processing time is not a column of a record: take it from the streaming query progress.
    """
    return bugs.agg(*monitoring_aggregates()).select("records", metric_rows())


def extraction_events(bugs: DataFrame) -> DataFrame:
    """One event per record and field."""
    rows = [
        F.struct(
            F.lit(f).alias("field"),
            F.col(f"{f}.confidence").alias("confidence"),
            F.col(f"{f}.source").alias("source"),
            F.col(f"{f}.value").isNotNull().alias("success"),
            F.col(f"{f}.extraction_timestamp").alias("timestamp"),
        )
        for f in FIELDS
    ]
    return bugs.select(
        F.lit("field_extraction").alias("event"),
        "bug_id",
        F.col("source_metadata.source_id").alias("source_id"),
        F.inline(F.array(*rows)),
    )


def pipeline_events(bugs: DataFrame) -> DataFrame:
    """One event per record. There is no processing time per row in a distributed job."""
    return bugs.select(
        F.lit("pipeline_complete").alias("event"),
        "bug_id",
        F.col("source_metadata.source_id").alias("source_id"),
        F.col("source_metadata.source_type").alias("source_type"),
        "overall_confidence",
        F.col("fields_extracted_by_regex").alias("regex_fields"),
        F.col("fields_enriched_by_nlp").alias("nlp_fields"),
        F.col("processing_timestamp").alias("timestamp"),
    )
