import itertools
import pathlib
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bugsieve.llm import sharding


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (3, 4), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    place = {sharding.hilbert_index(p, bits): p for p in itertools.product(range(1 << bits), repeat=dims)}
    assert sorted(place) == list(range(1 << (dims * bits)))
    for i in range(len(place) - 1):
        assert sum(abs(a - b) for a, b in zip(place[i], place[i + 1], strict=True)) == 1


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_runs_of_the_curve(spark, small, shards):
    docs = spark.read.parquet(f"{small}/documents.parquet").drop("n_chars")
    extra = [(None, None, None, None), (-1, "", "en", "src0"), (-1, "", "en", "src0"), (-2, "é" * 40_000, None, "src1")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("slot", F.lit("x"))
    rows = sharding.shard_documents(docs, shards).collect()
    n = docs.count()
    assert len(rows) == n
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert all(slots == list(range(len(slots))) for slots in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    order = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_fewer_rows_than_shards_and_none(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted(r.slot for r in sharding.shard_documents(docs.limit(3)).collect()) == [0, 0, 0]
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_written_shards(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    levels = sharding.quantile_levels(docs, [F.octet_length("text"), sharding.name_number(F.col("lang"))])
    sharding.write_shards(docs, levels, [F.col("doc_id")], f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count()
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_name_numbers_keep_the_order(spark):
    names = ["", "a", "aa", "ab", "b", "src0", "src1", "src10", "src2", "zz", "Ünï", "日本", "src1234567", "src1234599"]
    got = spark.createDataFrame([(n,) for n in [*names, None]], "n string").select("n", sharding.name_number(F.col("n")).alias("x")).collect()
    number = {r.n: r.x for r in got}
    ordered = sorted(names, key=lambda n: n.encode())
    for a, b in zip(ordered, ordered[1:], strict=False):
        assert number[a] <= number[b]
        assert (number[a] < number[b]) == (a.encode()[:7].ljust(7, b"\0") < b.encode()[:7].ljust(7, b"\0"))
    assert number[None] == number[""]


def test_filters_skip_files(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("size", F.octet_length("text"))
    numbers = [F.col("size"), sharding.name_number(F.col("lang")), sharding.name_number(F.col("source"))]
    sharding.write_shards(docs, sharding.quantile_levels(docs, numbers), [F.col("doc_id")], f"{tmp_path}/out", 32)
    files = [pq.ParquetFile(f) for f in pathlib.Path(f"{tmp_path}/out").rglob("*.parquet")]

    def ranges(file):
        out = {}
        for g in range(file.metadata.num_row_groups):
            for c in range(file.metadata.num_columns):
                column = file.metadata.row_group(g).column(c)
                if column.path_in_schema in ("size", "lang", "source"):
                    low, high = out.get(column.path_in_schema, (column.statistics.min, column.statistics.max))
                    out[column.path_in_schema] = min(low, column.statistics.min), max(high, column.statistics.max)
        return out

    held = [ranges(f) for f in files]
    assert len(held) >= 32
    middle, large = docs.select(F.percentile_approx("size", [0.5, 0.9])).first()[0]
    for wanted, most in (
        ({"source": ("src5", "src5")}, 0.6), ({"lang": ("de", "de")}, 0.6), ({"size": (large, 10**9)}, 0.6),
        ({"source": ("src5", "src9"), "size": (0, middle)}, 0.4), ({"lang": ("fr", "fr"), "size": (large, 10**9)}, 0.3),
    ):
        read = [h for h in held if all(h[c][0] <= high and h[c][1] >= low for c, (low, high) in wanted.items())]
        assert 0 < len(read) <= most * len(held), (wanted, len(read), len(held))
