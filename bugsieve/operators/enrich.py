"""Optional second look at weak fields: a built-in inference and a plug for callers."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.functions import scoring
from bugsieve.schema import FIELDS

ENRICHED_CONFIDENCE = 0.5
ENRICHED_SOURCE = "nlp_enriched"
EVIDENCE_CHARS = 500

# (field name, text, observed value, row needs enrichment) -> proposed value, or None for no opinion
Enricher = Callable[[str, Column, Column, Column], "Column | None"]


@dataclass(frozen=True)
class BatchEnricher:
    """An enricher that proposes values for several fields in one call of a pandas function."""

    fields: tuple[str, ...]
    propose: Callable[..., Column]


def infer_expected(field: str, text: Column, observed: Column, wanted: Column) -> Column | None:
    """Built-in enricher: the expected behavior is the absence of the observed one."""
    if field != "expected_behavior":
        return None
    return F.when(
        observed.isNotNull() & (observed != ""),
        F.concat(F.lit("[NLP-inferred] System should not "), observed),
    )


def vectorized_enricher(
    infer: Callable[[pd.Series, pd.Series, pd.Series], pd.Series],
    fields: tuple[str, ...] = FIELDS,
) -> BatchEnricher:
    """Make an enricher of a pandas function ``(field, text, observed) -> value``.

    The function sees only the rows whose field is weak, one field at a time and in order, so
    that it finds a replaced observed behavior when it comes to the expected one. All fields
    share one trip to Python, in which a text is sent once, and a row without a weak field
    sends nulls. Spark bounds the rows sent together by count and by bytes
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``).
    """
    fields = tuple(f for f in FIELDS if f in fields)

    @F.pandas_udf(", ".join(f"{f} string" for f in fields))
    def propose(text: pd.Series, observed: pd.Series, weak: pd.DataFrame) -> pd.DataFrame:
        observed = observed.astype(object)
        out = pd.DataFrame({f: pd.Series([None] * len(text), index=text.index, dtype=object) for f in fields})
        for f in fields:
            rows = weak[f].fillna(False).astype(bool)
            if rows.any():
                name = pd.Series([f] * int(rows.sum()), index=text.index[rows])
                out.loc[rows, f] = infer(name, text[rows], observed[rows])
                if f == "observed_behavior":
                    taken = rows & out[f].notna() & (out[f] != "")
                    observed = observed.where(~taken, out[f])
        return out

    # A filter on its result must not be pushed below it, where it would be called again.
    return BatchEnricher(fields, propose.asNondeterministic())


def enrich(
    bugs: DataFrame,
    threshold: float = 0.5,
    enricher: Enricher | BatchEnricher = infer_expected,
    text_col: str = "text",
) -> DataFrame:
    """Replace weak fields by what the enricher proposes and recompute the overall confidence.

    Needs the text next to the record. Fields are visited in order, so a proposal for the
    expected behavior can use a replaced observed behavior.
    """
    text = F.col(text_col)
    weak = F.size(scoring.low_confidence_fields(threshold)) > 0
    out = bugs.withColumn("nlp_enrichment_applied", weak)
    if isinstance(enricher, BatchEnricher):
        flags = {f: F.coalesce(scoring.is_low(f, threshold), F.lit(False)) for f in enricher.fields}
        some = functools.reduce(operator.or_, flags.values())
        out = out.withColumn(
            "__proposals",
            enricher.propose(
                F.when(some, text), F.when(some, F.col("observed_behavior.value")),
                F.struct(*[flags[f].alias(f) for f in enricher.fields]),
            ),
        )
    for f in FIELDS:
        wanted = scoring.is_low(f, threshold)
        if isinstance(enricher, BatchEnricher):
            proposal = F.col("__proposals")[f] if f in enricher.fields else None
        else:
            proposal = enricher(f, text, F.col("observed_behavior.value"), wanted)
        if proposal is None:
            continue
        proposed = f"__proposed_{f}"
        out = out.withColumn(proposed, F.when(wanted, proposal))
        taken = F.coalesce(F.col(proposed) != "", F.lit(False))
        field = F.col(f)
        out = out.withColumns(
            {
                f: F.when(
                    taken,
                    F.struct(
                        F.col(proposed).alias("value"),
                        F.lit(ENRICHED_CONFIDENCE).alias("confidence"),
                        F.lit(ENRICHED_SOURCE).alias("source"),
                        F.left(text, F.lit(EVIDENCE_CHARS)).alias("raw_evidence"),
                        field["extraction_timestamp"].alias("extraction_timestamp"),
                    ),
                ).otherwise(field),
                "fields_enriched_by_nlp": F.col("fields_enriched_by_nlp") + taken.cast("int"),
            }
        ).drop(proposed)
    return out.drop("__proposals").withColumn("overall_confidence", scoring.overall_confidence())
