"""Defect reports from logs, free text and work items, normalized with Spark."""

from bugsieve.config import Options
from bugsieve.functions.rules import Rule, default_rules, registry_counts, rules_df
from bugsieve.operators.combine import merge_evidence, merge_merged, split_reports
from bugsieve.operators.enrich import enrich, infer_expected, vectorized_enricher
from bugsieve.operators.extract import (
    best_in_tier, extract_all_fields, extract_field, extract_fields, rule_hits,
)
from bugsieve.operators.incremental import append_new, new_rows, processed_ids, read_batches
from bugsieve.operators.reports import (
    batch_stats, bug_summary, extraction_events, failed_items, field_extraction_rate,
    field_quality_distribution, monitoring_metrics, pipeline_events, run_stats,
)
from bugsieve.operators.run_report import RunReport
from bugsieve.operators.validate import validate_bugs
from bugsieve.plans.normalize import normalize
from bugsieve.sinks.records import to_json, write_bugs
from bugsieve.sources.files import (
    check_manifest, check_paths, document_placeholders, empty_files, missing_files, read_binary_docs,
    read_error_logs, read_folder, scan_directory,
)
from bugsieve.sources.freetext import read_freetext
from bugsieve.sources.inventory import inventory, sizes_of
from bugsieve.sources.spread import spread
from bugsieve.sources.staging import as_staging, rejects, split_rejects, union_sources
from bugsieve.sources.workitems import read_ado
from bugsieve.streaming.normalize_stream import (
    normalize_stream, read_log_stream, windowed_monitoring, windowed_quantiles, write_stream,
)
from bugsieve.streaming.late_rows import late_records, monitor_with_late_rows, window_metrics
from bugsieve.streaming.merge_stream import compact, merge_stream, merged_incidents
from bugsieve.streaming.progress import processing_time, progress_rows

__all__ = [n for n in dir() if not n.startswith("_")]
