import duckdb
import pytest

from bugsieve.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_other_queries_run(spark, small, name):
    frame = QUERIES[name](spark, small)
    assert frame.columns[0] in ("doc_id", "page_id")
    assert frame.count() > 0
