"""Confidence arithmetic: on plain numbers for plan-time tables, on columns for data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bugsieve.schema import FIELDS

# Source weights, evidence bonus, short-value penalty, level bounds.
SOURCE_WEIGHTS = {
    "ado_api": 1.0,
    "regex_strict": 0.95,
    "rule_based": 0.85,
    "regex_loose": 0.70,
    "user_provided": 0.60,
    "nlp_enriched": 0.50,
}
UNKNOWN_WEIGHT = 0.5
EVIDENCE_BONUS = 0.05
SHORT_LENGTH = 5
SHORT_FACTOR = 0.8
LEVEL_HIGH = 0.8
LEVEL_MEDIUM = 0.5
REPEAT_STEP = 0.1
REPEAT_MAX = 0.2


def boosted(base: float, matches: int) -> float:
    """Rule confidence after ``matches`` hits, as a number."""
    return min(base + min(REPEAT_STEP * (matches - 1), REPEAT_MAX), 1.0)


def scored(base: float, source: str, has_evidence: bool, value_length: int) -> float:
    """Final confidence of one extracted value, as a number."""
    points = base * SOURCE_WEIGHTS.get(source, UNKNOWN_WEIGHT)
    if has_evidence:
        points = min(points + EVIDENCE_BONUS, 1.0)
    if 0 < value_length < SHORT_LENGTH:
        points *= SHORT_FACTOR
    return round(points, 3)


def occurrence_boost(base: Column, matches: Column) -> Column:
    """Rule confidence after ``matches`` hits."""
    extra = F.least(F.lit(REPEAT_STEP) * (matches - 1), F.lit(REPEAT_MAX))
    return F.least(base + extra, F.lit(1.0))


def round_exact(c: Column, digits: int = 3) -> Column:
    """Round a double in [0, 1] by its exact value, ties to even, as Python's ``round`` does.

    ``round`` in SQL looks at the shortest decimal form: 0.9335 is stored a little lower and
    belongs to 0.933, but gives 0.934. Here the error of the scaled product is computed as well
    (both factors are short enough for their halves to multiply without loss).
    """
    scale = 10.0**digits
    split = c * 134217729.0  # 2**27 + 1 cuts a double into two halves
    high = split - (split - c)
    product = c * scale
    error = (high * scale - product) + (c - high) * scale
    whole = F.floor(product)
    rest = product - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    return (whole + up.cast("int")) / scale


def score_field(
    base: Column, source: Column, has_evidence: Column, value_length: Column
) -> Column:
    """Final confidence for any base, equal to ``scored``."""
    weight = F.lit(UNKNOWN_WEIGHT)
    for name, w in SOURCE_WEIGHTS.items():
        weight = F.when(source == name, F.lit(w)).otherwise(weight)
    points = base * weight
    points = F.when(has_evidence, F.least(points + EVIDENCE_BONUS, F.lit(1.0))).otherwise(points)
    short = (value_length > 0) & (value_length < SHORT_LENGTH)
    return round_exact(F.when(short, points * SHORT_FACTOR).otherwise(points))


def confidence_level(
    confidence: Column, high: float = LEVEL_HIGH, medium: float = LEVEL_MEDIUM
) -> Column:
    return (
        F.when(confidence >= high, F.lit("high"))
        .when(confidence >= medium, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def needs_enrichment(confidence: Column, threshold: float | None = None) -> Column:
    """True below the threshold; no threshold, or zero, means the medium bound."""
    return confidence < (threshold or LEVEL_MEDIUM)


def _count(flags: list[Column]) -> Column:
    total = F.lit(0)
    for flag in flags:
        total = total + flag.cast("int")
    return total


def filled_fields() -> Column:
    """Number of core fields that hold a value."""
    return _count([F.col(f"{f}.value").isNotNull() for f in FIELDS])


def overall_confidence() -> Column:
    """Mean confidence of the filled fields times the filled share; 0 when none is filled."""
    total = F.lit(0.0)
    for f in FIELDS:
        total = total + F.when(F.col(f"{f}.value").isNotNull(), F.col(f"{f}.confidence")).otherwise(0.0)
    filled = filled_fields()
    return F.when(filled > 0, (total / filled) * (filled / len(FIELDS))).otherwise(F.lit(0.0))


def completeness() -> Column:
    return filled_fields() / len(FIELDS)


def is_low(field: str, threshold: float) -> Column:
    return F.col(f"{field}.value").isNull() | (F.col(f"{field}.confidence") < threshold)


def low_confidence_fields(threshold: float = 0.5) -> Column:
    """Names of the fields that are empty or below the threshold, in field order."""
    return F.array_compact(F.array(*[F.when(is_low(f, threshold), F.lit(f)) for f in FIELDS]))


def regex_field_count() -> Column:
    """Number of fields filled by a strict or loose rule."""
    return _count(
        [
            F.coalesce(
                F.col(f"{f}.value").isNotNull()
                & F.col(f"{f}.source").isin("regex_strict", "regex_loose"),
                F.lit(False),
            )
            for f in FIELDS
        ]
    )
