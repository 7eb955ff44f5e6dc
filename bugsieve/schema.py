"""Fixed schemas: the staging frame every source produces and the record every source becomes."""

from pyspark.sql import types as T

# Field names and enumerations of the record format.
FIELDS = (
    "error_type",
    "component_module",
    "trigger_repro_steps",
    "observed_behavior",
    "expected_behavior",
)
OPTIONAL_FIELDS = ("severity", "environment", "failure_classification")
SOURCE_TYPES = ("error_log", "freetext", "ado_bug")
EXTRACTION_SOURCES = (
    "regex_strict",
    "regex_loose",
    "rule_based",
    "ado_api",
    "nlp_enriched",
    "user_provided",
)
SCHEMA_VERSION = "1.0.0"

METADATA = T.StructType(
    [
        T.StructField("source_type", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("ado_work_item_id", T.StringType()),
        T.StructField("raw_text_length", T.LongType()),
    ]
)

STAGING = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("source_metadata", METADATA),
        T.StructField("reject_reason", T.StringType()),
    ]
)

FIELD = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("raw_evidence", T.StringType()),
        T.StructField("extraction_timestamp", T.TimestampType()),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("bug_id", T.StringType()),
        T.StructField("schema_version", T.StringType()),
        T.StructField("source_metadata", METADATA),
        *[T.StructField(f, FIELD) for f in FIELDS],
        *[T.StructField(f, FIELD) for f in OPTIONAL_FIELDS],
        T.StructField("overall_confidence", T.DoubleType()),
        T.StructField("fields_extracted_by_regex", T.IntegerType()),
        T.StructField("fields_enriched_by_nlp", T.IntegerType()),
        T.StructField("total_extractable_fields", T.IntegerType()),
        T.StructField("processing_timestamp", T.TimestampType()),
        T.StructField("nlp_enrichment_applied", T.BooleanType()),
    ]
)
