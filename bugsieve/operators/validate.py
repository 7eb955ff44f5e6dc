"""Record checks: ranges, lengths and enumerations of the record schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.schema import EXTRACTION_SOURCES, FIELDS, SOURCE_TYPES

MAX_EVIDENCE = 500


def violations() -> Column:
    """Names of the rules a record breaks; an empty array for a valid one."""

    def outside(c: str) -> Column:
        return F.coalesce(~F.col(c).between(0.0, 1.0), F.lit(True))

    def not_in(c: str, allowed: tuple[str, ...]) -> Column:
        return F.coalesce(~F.col(c).isin(*allowed), F.lit(True))

    checks = [
        F.when(not_in("source_metadata.source_type", SOURCE_TYPES), F.lit("source_metadata.source_type")),
        F.when(outside("overall_confidence"), F.lit("overall_confidence")),
    ]
    for f in FIELDS:
        checks += [
            F.when(outside(f"{f}.confidence"), F.lit(f"{f}.confidence")),
            F.when(not_in(f"{f}.source", EXTRACTION_SOURCES), F.lit(f"{f}.source")),
            F.when(F.length(f"{f}.raw_evidence") > MAX_EVIDENCE, F.lit(f"{f}.raw_evidence")),
        ]
    return F.array_compact(F.array(*checks))


def validate_bugs(bugs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records, and the others with a ``violations`` column."""
    checked = bugs.withColumn("violations", violations())
    good = checked.where(F.size("violations") == 0).drop("violations")
    return good, checked.where(F.size("violations") > 0)
