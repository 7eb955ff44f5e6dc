"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

Usage: python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import collections
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.queries import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def rows_of(records, columns) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(x):
        return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else (
            str(x) if x is not None and not isinstance(x, bool) else x
        )

    return collections.Counter(tuple(cell(r[i]) for i in order) for r in records)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in names:
        t = time.time()
        df = QUERIES[name](spark, sf_dir)
        got = df.collect()
        took = time.time() - t
        if name not in ORACLES:
            print(f"{name}: rows only, {len(got)} rows, {took:.1f} s", flush=True)
            continue
        t = time.time()
        cur = con.execute(ORACLES[name])
        columns = [d[0] for d in cur.description]
        want = cur.fetchall()
        sql_took = time.time() - t
        same_columns = sorted(columns) == sorted(df.columns)
        a, b = rows_of(got, df.columns), rows_of(want, columns)
        ok = same_columns and a == b
        bad += not ok
        print(f"{'ok  ' if ok else 'DIFF'} {name}: {len(got)} rows, {took:.1f} s (sql {sql_took:.1f} s)", flush=True)
        if not ok:
            if not same_columns:
                print("   columns", sorted(df.columns), sorted(columns))
            print("   spark", len(got), "duckdb", len(want), sorted(columns))
            for label, diff in (("spark only", a - b), ("duckdb only", b - a)):
                for row in sorted(diff, key=str)[:2]:
                    print("   ", label, str(row)[:700])
    print(f"{len(names)} queries, {bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
