"""Registered queries: names, columns, and rows against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks import compare
from checks.queries import ORACLES, QUERIES

FAST = [
    "s1_read_error_logs", "s4_scan_directory", "s6_check_paths", "s7_read_folder", "t1_stream_files", "u1_custom_enricher", "s2_read_freetext", "s3_read_ado", "s6_reject_invalid", "c1_clean_freetext", "c5_redact_pii", "c6_flag_unsafe_paths",
    "x2_rule_hits", "n1_normalize", "e1_enrich", "a5_field_quality_distribution", "t1_normalize_stream",
    "t2_windowed_monitoring", "t3_merge_evidence", "t4_split_reports", "flagship_what_broke",
]


def test_contract(spark, small):
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == [
        "source_type", "error_type", "component_module", "reports", "mean_confidence",
    ]


@pytest.mark.parametrize("name", FAST)
def test_query(spark, small, name):
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert compare.rows_of(df.collect(), df.columns) == compare.rows_of(cur.fetchall(), columns)
