"""Near-duplicate texts by SimHash fingerprints within a few bits (segment-popcount embedding)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import appended, columns_of, free_names, release_memory, saved
from bugsieve.llm.components import component_labels

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Coordinate groups that two linked fingerprints must share, besides one for each bit allowed.
SHARED_GROUPS = 3
#: Largest cell compared by pairs. Beyond it, walking over the neighbourhood of each
#: fingerprint (some 2,000 points at three bits) is the cheaper exact way.
CELL_ROWS = 16_384

_ODD = 0x5555555555555555


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_of(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's k-word shingles as a signed number; no word gives zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < k:
        hashes = [digest(b" ".join(words), 42)]
    else:
        join = b" ".join
        hashes = [digest(join(s), 42) for s in zip(*(words[i:] for i in range(k)), strict=False)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        block = np.array(hashes[at : at + 65_536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(id, fp): one row per input row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint_of(x.as_py(), shingle_words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, type=pa.int64())], names=["id", "fp"]
            )
        release_memory()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each in unary: 00, 01 or 11.

    In unary the Manhattan distance of two embeddings is the number of bits in which they
    differ, and it is never above the Hamming distance of the fingerprints.
    """
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_ODD)), fp.bitwiseAND(F.lit(_ODD))
    return high.bitwiseOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def cell_masks(max_bits: int) -> list[int]:
    """One mask for each choice of coordinate groups that a pair within max_bits may share whole.

    The 32 coordinates fall into max_bits + 3 groups. A Manhattan distance of max_bits touches
    at most max_bits of them, so some three groups are equal: those pairs share a grid cell.
    """
    n = max_bits + SHARED_GROUPS
    groups = [0] * n
    for segment in range(32):
        groups[segment % n] |= 3 << (2 * segment)
    return [_signed(sum(c)) for c in itertools.combinations(groups, SHARED_GROUPS)]


def _links(members: np.ndarray, embedded: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links within one cell, a row of distances at a time."""
    left = np.ones(len(members), dtype=bool)
    for root in range(len(members)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(embedded[rest] ^ embedded[at]) <= max_bits]
            near = near[np.bitwise_count(members[near] ^ members[at]) <= max_bits]
            left[near] = False
            queue.extend(near.tolist())
            for other in near:
                yield int(members[at]), int(members[other])


def _cell_links(cells: DataFrame, max_bits: int) -> DataFrame:
    odd = np.uint64(_ODD)
    one = np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            high, low = (values >> one) & odd, values & odd
            embedded = (high | low) | ((high & low) << one)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            starts = np.r_[0, ends[:-1]].astype(np.int64)
            pairs = starts[ends - starts == 2]
            near = pairs[np.bitwise_count(embedded[pairs] ^ embedded[pairs + 1]) <= max_bits]
            near = near[np.bitwise_count(values[near] ^ values[near + 1]) <= max_bits]
            a.append(values[near])
            b.append(values[near + 1])
            for i in np.flatnonzero(ends - starts > 2):
                found = list(_links(values[starts[i] : ends[i]], embedded[starts[i] : ends[i]], max_bits))
                if found:
                    x = np.array(found, dtype=np.uint64)
                    a.append(x[:, 0])
                    b.append(x[:, 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

    return cells.select("members").mapInArrow(run, "a long, b long")


def _hub_links(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links among the fingerprints of crowded cells, without comparing pairs.

    Two fingerprints within max_bits have a point between them, near (at most half the bits)
    to one and far (the rest) from the other. All that is near a point is linked, and so is
    whatever is far from it if anything is near; a point with no near fingerprint links nothing.
    """
    reach = max_bits // 2, max_bits - max_bits // 2
    masks = [
        (_signed(sum(1 << i for i in c)), n)
        for n in range(reach[1] + 1)
        for c in itertools.combinations(range(64), n)
    ]
    flips = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(n).alias("n")) for m, n in masks])
    points = crowded.select("fp", F.explode(flips).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip.m")).alias("point"), "fp", (F.col("flip.n") <= reach[0]).alias("near")
    )
    hubs = points.where("near").groupBy("point").agg(F.min("fp").alias("b"))
    return points.join(hubs, "point").select(F.col("fp").alias("a"), "b").where("a <> b")


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints within max_bits of one another.

    Cells of the grid over the embedding bring candidates together; a cell gives a spanning
    forest of its links, never all pairs. Cells with more than ``cell_rows`` fingerprints are
    handled through the points around each fingerprint instead, which is exact as well.
    """
    masks = cell_masks(max_bits)
    cells = F.array(
        *[F.struct(F.lit(i).alias("c"), F.col("e").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(masks)]
    )
    placed = (
        fps.select("fp").distinct().select("fp", embedding(F.col("fp")).alias("e"))
        .select("fp", F.explode(cells).alias("cell")).select("cell.c", "cell.key", "fp")
    )
    sizes = placed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = saved(placed.join(sizes, ["c", "key"]), "cells")
    lists = shared.where(F.col("n") <= cell_rows).groupBy("c", "key").agg(F.collect_list("fp").alias("members"))
    found = _cell_links(lists, max_bits)
    crowded = shared.where(F.col("n") > cell_rows).select("fp").distinct()
    if crowded.limit(1).count():
        found = found.unionByName(_hub_links(crowded, max_bits))
    return found


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per input row.

    Fingerprints that differ in at most ``max_bits`` bits are linked; ``component_id`` is the
    smallest id that links reach. Null and empty texts have fingerprint zero and are linked like
    any other; rows with a null id take part, but a component with no other id has a null
    ``component_id``. Repeated rows stay repeated. An empty table gives an empty result, and
    other columns of ``docs`` are ignored.
    """
    fps, labelled = _labelled(docs, id_col, text_col, shingle_words, max_bits, cell_rows)
    # As a table of its own, so that the join below can split a component of very many nodes.
    heads = saved(labelled.groupBy("label").agg(F.min("first").alias("component_id")), "heads")
    known = labelled.join(heads, "label").select("fp", "component_id")
    return fps.join(known, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _labelled(
    docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int, cell_rows: int
) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row, and (fp, first, label): each fingerprint's smallest id and component."""
    fps = saved(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    labels = component_labels(links(fps, max_bits, cell_rows))
    nodes = fps.groupBy("fp").agg(F.min("id").alias("first"))
    return fps, nodes.join(labels, nodes.fp == labels.u, "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("label")
    )


def one_of_each_component(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``docs``, with their columns, one for each component: the one with the smallest
    id and, where that id has several texts, the smallest fingerprint among them.

    A component is known by (id, fingerprint), since an id may stand on texts of several components;
    of rows equal in both, the one with the smallest text hash stays (then by its other columns). Rows
    without an id are no document that a component could name; all of them stay.
    """
    fps, labelled = _labelled(docs, id_col, text_col, shingle_words, max_bits, CELL_ROWS)
    heads = saved(
        labelled.where("first IS NOT NULL").groupBy("label").agg(F.min(F.struct("first", "fp")).alias("head"))
        .select(F.col("head.first").alias("id"), F.col("head.fp").alias("fp")),
        "heads",
    )
    repeated = saved(
        fps.where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"),
        "repeated",
    )
    name, fp, row, order = free_names(docs, "id_", "fp_", "row_", "order_")
    given = F.col(f"`{id_col}`")
    # An id on one row needs no look at the text; the fingerprint of the others is made again.
    once = heads.join(repeated, "id", "left_anti").select(F.col("id").alias(name))
    alone = docs.join(once, given == F.col(name), "left_semi")
    several = docs.join(repeated.select(F.col("id").alias(name)), given == F.col(name), "left_semi")
    text = f"{name}text"
    marked = appended(
        several.withColumn(text, F.col(f"`{text_col}`").cast("binary")), [text],
        [T.StructField(fp, T.LongType())],
        lambda texts: [pa.array([fingerprint_of(x.as_py(), shingle_words) for x in texts], type=pa.int64())],
    )
    headed = heads.toDF(name, f"{fp}head")
    whole = F.struct(*columns_of(docs))
    several = (
        marked.join(headed, (given == F.col(name)) & (F.col(fp) == F.col(f"{fp}head")))
        .select(F.col(name), F.col(fp), whole.alias(row),
                F.struct(F.xxhash64(F.col(f"`{text_col}`")), F.to_json(whole)).alias(order))
        .groupBy(name, fp).agg(F.min_by(row, order).alias(row)).select(f"{row}.*")
    )
    return alone.unionByName(several).unionByName(docs.where(given.isNull()))
