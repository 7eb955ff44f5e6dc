"""Staging frame to normalized records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.config import Options
from bugsieve.functions import scoring
from bugsieve.functions.rules import Rule
from bugsieve.operators.enrich import BatchEnricher, Enricher, enrich, infer_expected
from bugsieve.operators.extract import RESULT, extract_fields
from bugsieve.schema import FIELD, FIELDS, OPTIONAL_FIELDS, RECORD, SCHEMA_VERSION
from bugsieve.sources.staging import as_staging


def _record_field(name: str) -> Column:
    """Extraction result as a record field; an empty one is loose with confidence 0."""
    hit = F.col(name)
    return F.struct(
        hit["value"].alias("value"),
        F.coalesce(hit["confidence"], F.lit(0.0)).alias("confidence"),
        F.coalesce(hit["source"], F.lit("regex_loose")).alias("source"),
        hit["raw_evidence"].alias("raw_evidence"),
        F.current_timestamp().alias("extraction_timestamp"),
    ).alias(name)


def content_id() -> Column:
    """SHA-256 of a staging row's source id and text: equal inputs get equal ids, so a replayed batch
    can be merged instead of appended."""
    return F.sha2(F.concat_ws("\x00", F.col("source_metadata.source_id"), F.col("text")), 256)


def _bug_id(mode: str) -> Column:
    return content_id() if mode == "content" else F.uuid()


def normalize(
    staging: DataFrame,
    *,
    enable_enrichment: bool = False,
    threshold: float = 0.5,
    rules: Sequence[Rule] | None = None,
    enricher: Enricher | BatchEnricher = infer_expected,
    id_mode: str = "random",
    fields: Sequence[str] = FIELDS,
    keep: Sequence[str] = (),
    keep_text: bool = False,
) -> DataFrame:
    """One record per accepted staging row, in the fixed record schema.

    Rejected rows are left out (see ``split_rejects``). ``keep`` names staging columns to carry
    along. The whole plan is narrow: no shuffle, and the same for batch and streaming frames.

    ``fields`` names the fields to extract; the rules of all others are not run, and those
    fields are as empty as where no rule hits. ``id_mode="random"`` makes new ids each time the
    plan runs, for a retried task or a second report as well: use ``"content"``, or write the
    records first, where ids of several results must agree. Content ids are SHA-256 of source
    id and text, so inputs that are equal in both, such as work items without an id, share one.
    """
    options = Options(enable_enrichment=enable_enrichment, threshold=threshold, id_mode=id_mode)
    good = as_staging(staging).where(F.col("reject_reason").isNull())
    found = extract_fields(good.drop("reject_reason"), fields, rules)
    found = found.withColumns({f: F.lit(None).cast(RESULT) for f in FIELDS if f not in fields})
    built = found.select(
        _bug_id(options.id_mode).alias("bug_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "source_metadata",
        *[_record_field(f) for f in FIELDS],
        *[F.lit(None).cast(FIELD).alias(f) for f in OPTIONAL_FIELDS],
        "text",
        *keep,
    )
    bugs = built.withColumns(
        {
            "overall_confidence": scoring.overall_confidence(),
            "fields_extracted_by_regex": scoring.regex_field_count(),
            "fields_enriched_by_nlp": F.lit(0),
            "total_extractable_fields": F.lit(len(FIELDS)),
            "processing_timestamp": F.current_timestamp(),
            "nlp_enrichment_applied": F.lit(False),
        }
    )
    if options.enable_enrichment:
        bugs = enrich(bugs, threshold=options.threshold, enricher=enricher)
    text = ["text"] if keep_text else []
    return bugs.select(*RECORD.fieldNames(), *keep, *text)
