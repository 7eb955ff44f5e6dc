"""Shards along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugsieve.llm.common import columns_of

#: Bits of each dimension; three dimensions make 4,096 cells of the curve.
BITS = 4
#: A cell's rows are numbered in so many parts, so that no cell is one task's work.
SALTS = 64


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """The place of a grid point on the Hilbert curve (transposed Gray code, most significant bit first)."""
    x = list(point)
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            flip ^= q - 1
        q >>= 1
    index = 0
    for bit in reversed(range(bits)):
        for value in x:
            index = index << 1 | (value ^ flip) >> bit & 1
    return index


#: Bytes of a name that its level is taken from.
NAME_BYTES = 7


def name_number(name: Column) -> Column:
    """The first bytes of a name as a number that orders as they do; null counts as the empty name."""
    data = F.substring(F.coalesce(name, F.lit("")).cast("binary"), 1, NAME_BYTES)
    return F.conv(F.rpad(F.hex(data), 2 * NAME_BYTES, "0"), 16, 10).cast("long")


def quantile_levels(docs: DataFrame, numbers: list[Column], bits: int = BITS) -> list[Column]:
    """Each number as one of 2**bits levels that keep its order and hold rows in about equal shares.

    The bounds are quantiles (one pass of mergeable sketches, 2**bits - 1 numbers each). So a run of
    levels is a range of values, which Parquet's minima and maxima can rule out.
    """
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = docs.agg(*(F.percentile_approx(n, cuts, 10_000).alias(f"q{i}") for i, n in enumerate(numbers))).first()
    return [_level(n, found[f"q{i}"] or []) for i, n in enumerate(numbers)]


def _level(number: Column, bounds: list[int]) -> Column:
    """How many bounds a number has passed. One that is several bounds takes their middle, so that
    the levels use all of their range."""
    given = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<long>")
    below = F.size(F.filter(given, lambda b: b < number))
    upto = F.size(F.filter(given, lambda b: b <= number))
    return F.coalesce(F.floor((below + upto) / 2), F.lit(0)).cast("int")


def hilbert_shards(
    docs: DataFrame,
    levels: list[Column],
    order: list[Column],
    shards: int = 8,
    bits: int = BITS,
    salts: int = SALTS,
) -> DataFrame:
    """The rows with ``shard``, ``slot`` and ``curve``: runs of the curve, at most a row apart in length.

    ``levels`` are the quantised dimensions (0 to 2**bits - 1, never null); rows next to each
    other on the curve are alike in all of them, so each shard's files cover small ranges.
    ``order`` numbers rows within a cell and must be deterministic. Cell sizes are counted first
    (at most 2**(bits * dimensions) * salts numbers, which are broadcast), then rows are numbered
    within parts of a cell: one shuffle, and no cell is a single task's work. Rows whose
    ``order`` values are all equal are interchangeable. Columns of the three names give way. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    n = len(levels)
    code = sum((x.cast("int") * (1 << (bits * i)) for i, x in enumerate(levels)), F.lit(0))
    curve = spark.createDataFrame(
        [
            (sum(v << (bits * i) for i, v in enumerate(p)), hilbert_index(p, bits))
            for p in itertools.product(range(1 << bits), repeat=n)
        ],
        "code int, curve int",
    )
    row = F.struct(*columns_of(docs, ("shard", "slot", "curve")))
    placed = (
        docs.select(row.alias("row"), code.alias("code"), F.struct(*order).alias("order"))
        .join(F.broadcast(curve), "code").drop("code")
        .withColumn("salt", F.pmod(F.xxhash64("order"), F.lit(salts)).cast("int"))
    )
    parts = placed.groupBy("curve", "salt").agg(F.count(F.lit(1)).alias("n"))
    cells = parts.groupBy("curve").agg(F.sum("n").alias("n"))
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "curve",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    within = Window.partitionBy("curve").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.join(F.broadcast(cells), "curve").select(
        "curve", "salt", "total",
        (F.col("cell_start") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("start"),
    )
    number = F.row_number().over(Window.partitionBy("curve", "salt").orderBy("order")) - 1
    ranked = placed.withColumn("number", number).join(F.broadcast(starts), ["curve", "salt"])
    return (
        ranked.withColumn("rank", F.col("start") + F.col("number"))
        .withColumn("shard", F.expr(f"(rank * {shards}) div total").cast("int"))
        .withColumn("slot", F.col("rank") - F.expr(f"(shard * total + {shards - 1}) div {shards}"))
        .select("row.*", "shard", "slot", "curve")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) of every document.

    Dimensions are the size of the text, the language and the source, each in levels of its own order
    (``quantile_levels``), so that filters on any of them rule out files. Law ``rows``: the counts
    of shards are at most one apart, whatever the texts; equal texts are not kept together.
    ``size`` is the text's UTF-8 bytes plus one; a null text has none. Null names form a level.
    Other columns are ignored; repeated rows are rows of their own.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), "lang", "source"
    )
    levels = quantile_levels(rows, [F.col("size"), name_number(F.col("lang")), name_number(F.col("source"))])
    out = hilbert_shards(rows, levels, [F.col(x) for x in ("doc_id", "text_crc32", "size", "lang", "source")], shards)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_shards(docs: DataFrame, levels: list[Column], order: list[Column], path: str, shards: int = 8) -> None:
    """Write the rows as Parquet, one folder a shard, each file sorted along the curve."""
    placed = hilbert_shards(docs, levels, order, shards)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
