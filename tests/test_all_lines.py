"""The file queries read every line, in both line-end styles, next to oversize and empty files."""

import duckdb
import pytest

from checks import compare
from checks.queries import EMPTY_FILES, ORACLES, QUERIES


@pytest.mark.parametrize("name", ["s1_read_error_logs", "t1_stream_files"])
def test_every_line_is_read(spark, small, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{small}/events.parquet'")
    df = QUERIES[name](spark, small)
    got = df.collect()
    cur = con.execute(ORACLES[name])
    assert compare.rows_of(got, df.columns) == compare.rows_of(cur.fetchall(), [d[0] for d in cur.description])
    read = [r for r in got if r.reject_reason is None and r.chunk is not None]
    # every event's line is at least this long
    shortest = con.execute("SELECT count(*) FROM events").fetchone()[0] * 40
    assert sum(r.raw_text_length for r in read) > shortest
    assert any(r.reject_reason for r in got)
    assert sum(r.chunk is None and r.raw_text_length == 0 for r in got) == EMPTY_FILES
    if name.startswith("s1"):
        assert any(r.file_size_bytes > r.raw_text_length for r in read)  # CR and invalid bytes went
