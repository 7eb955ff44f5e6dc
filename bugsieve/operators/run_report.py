"""Statistics of a run from the pass that writes its records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bugsieve.operators import reports
from bugsieve.sources.staging import as_staging


class RunReport:
    """Watches the inputs and the records of one job and reports on them without another pass::

        report = RunReport()
        bugs = report.records(normalize(report.inputs(staging)))
        write_bugs(bugs, path)
        report.run_stats().show()

    The counters are observed metrics of the job's own tasks: partial sums that travel with each task's
    result, so nothing is shuffled, extracted or scanned again. A report waits for the first action on
    the watched frame; an action that reads part of it, such as ``show``, counts that part. Tasks that
    are run again count once as long as the frames are watched in the job's last stage: watch the
    inputs after a redistribution (``spread``), not before. For batch frames.
    """

    def __init__(self) -> None:
        self._inputs, self._records = Observation(), Observation()
        self._spark: SparkSession | None = None
        self._with_inputs = False

    def inputs(self, staging: DataFrame) -> DataFrame:
        """The staging frame, its rows and rejects counted."""
        self._with_inputs = True
        staging = as_staging(staging)
        return staging.observe(
            self._inputs, F.count(F.lit(1)).alias("total"), F.count_if(F.col("reject_reason").isNotNull()).alias("failed")
        )

    def records(self, bugs: DataFrame) -> DataFrame:
        """The records, with the aggregates of all reports."""
        self._spark = bugs.sparkSession
        overall = F.col("overall_confidence")
        named: dict[str, Column] = {
            "max_confidence": F.max(overall), "min_confidence": F.min(overall),
        }
        parts = [
            *reports.batch_aggregates(), *reports.rate_aggregates(), *reports.quality_aggregates(),
            *reports.monitoring_aggregates(), *[c.alias(n) for n, c in named.items()],
        ]
        return bugs.observe(self._records, *parts)

    def _row(self) -> DataFrame:
        """One row with everything that was counted."""
        if self._spark is None:
            raise ValueError("no records are watched: pass the frame to records() first")
        found = dict(self._records.get)
        given = dict(self._inputs.get) if self._with_inputs else {}
        kinds = {int: "long", float: "double"}
        found["failed"] = int(given.get("failed", 0))
        found["total"] = int(given.get("total", found["total_processed"]))
        doubles = {n for n in found if n.startswith(("mean_", "max_", "min_")) or n.endswith(("_rate", "_pct"))}
        schema = ", ".join(f"{n} {'double' if n in doubles else kinds.get(type(v), 'long')}" for n, v in found.items())
        return self._spark.createDataFrame([tuple(found.values())], schema)

    def batch_stats(self) -> DataFrame:
        """As ``reports.batch_stats``."""
        return self._row().select("total_processed", "mean_confidence", *[f"{n}_confidence" for n in reports.LEVELS])

    def run_stats(self) -> DataFrame:
        """As ``reports.run_stats``; without watched inputs no row has failed."""
        ok = F.col("total_processed")
        return self._row().select(
            ok.alias("succeeded"), "failed", "total", "mean_confidence", "max_confidence", "min_confidence",
            *[f"{n}_confidence" for n in reports.LEVELS],
            *[(F.lit(100.0) * F.col(f"{n}_confidence") / F.nullif(ok, F.lit(0))).alias(f"{n}_pct") for n in reports.LEVELS],
        )

    def field_extraction_rate(self) -> DataFrame:
        """As ``reports.field_extraction_rate``."""
        return self._row().select("fields_extracted", "fields_possible", "extraction_rate_pct")

    def field_quality_distribution(self) -> DataFrame:
        """As ``reports.field_quality_distribution``."""
        return reports.quality_shares(self._row())

    def monitoring_metrics(self) -> DataFrame:
        """As ``reports.monitoring_metrics``."""
        return self._row().select("records", reports.metric_rows())
