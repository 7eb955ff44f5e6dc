"""Exact inner-product search by a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bugsieve.llm.common import saved

#: Pivots, and the vectors they are chosen from; both bound what the driver holds.
PIVOTS, PIVOT_SAMPLE = 32, 2_048
#: Vectors of an index block (a piece of an annulus) and queries of a query block.
BLOCK_ROWS, QUERY_ROWS = 4_096, 512
#: Rings of equal width around each pivot, and the shares of the reach to which annuli widen.
RINGS, REACHES = 64, (0.3, 1.0)

_BLOCK = "block long, pivot int, nearest double, farthest double, norm2 double, ids binary, dists binary, vectors binary"
_QUERY = "qblock long, pivot int, near array<double>, far array<double>, norm2 double, ids binary, vectors binary"


def scaled(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots far from one another, each then moved to the mean of the vectors nearest to it."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen = [sample[0]]
    dist = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < count and dist.max() > 0:
        chosen.append(sample[int(dist.argmax())])
        dist = np.minimum(dist, ((sample - chosen[-1]) ** 2).sum(1))
    pivots = np.array(chosen)
    for _ in range(5):
        near = _distances(sample, pivots).argmin(1)
        pivots = np.array([sample[near == i].mean(0) if (near == i).any() else p for i, p in enumerate(pivots)])
    return pivots


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([((vectors - p) ** 2).sum(1) for p in pivots], axis=1))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists as rows, filled up with zeros."""
    out = np.zeros((len(column), width), dtype=np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products: in floating point where that is exact, else in whole numbers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), dtype=np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if bound < 2**53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def _key_by_pivot(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dist = _distances(_matrix(batch.column(1), width).astype(np.float64), pivots)
            pivot = dist.argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot), pa.array(dist[np.arange(len(pivot)), pivot])],
                names=["id", "v", "pivot", "dist"],
            )

    return rows.mapInArrow(run, "id long, v array<long>, pivot int, dist double")


def _blocks(keyed: DataFrame, pivots: np.ndarray, width: int, most: int, for_queries: bool) -> DataFrame:
    """Rows sorted by pivot and distance, cut into blocks; a block has one pivot."""

    def close(block: int, pivot: int, ids: np.ndarray, dists: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        norm2 = float((vectors.astype(np.float64) ** 2).sum(1).max())
        data = np.ascontiguousarray(vectors).tobytes()
        if for_queries:
            to = _distances(vectors.astype(np.float64), pivots)
            row = {"qblock": block, "pivot": pivot, "near": to.min(0).tolist(), "far": to.max(0).tolist(), "norm2": norm2, "ids": ids.tobytes(), "vectors": data}
        else:
            row = {"block": block, "pivot": pivot, "nearest": float(dists.min()), "farthest": float(dists.max()), "norm2": norm2, "ids": ids.tobytes(), "dists": dists.tobytes(), "vectors": data}
        table = pa.Table.from_pylist([row])
        return table.cast(pa.schema([pa.field(f.name, pa.int32()) if f.name == "pivot" else f for f in table.schema])).to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        count = 0
        for batch in batches:
            ids, pivot, dist = (batch.column(i).to_numpy() for i in (0, 2, 3))
            vectors = _matrix(batch.column(1), width)
            at = 0
            while at < len(ids):
                if held and held[0][0] != pivot[at]:
                    yield close(block, int(held[0][0]), *(np.concatenate([h[i] for h in held]) for i in (1, 2, 3)))
                    block, held, count = block + 1, [], 0
                end = at + int(np.argmax(pivot[at:] != pivot[at])) if (pivot[at:] != pivot[at]).any() else len(ids)
                end = min(end, at + most - count)
                held.append((pivot[at], ids[at:end], dist[at:end], vectors[at:end]))
                count += end - at
                at = end
                if count == most:
                    yield close(block, int(held[0][0]), *(np.concatenate([h[i] for h in held]) for i in (1, 2, 3)))
                    block, held, count = block + 1, [], 0
        if held:
            yield close(block, int(held[0][0]), *(np.concatenate([h[i] for h in held]) for i in (1, 2, 3)))

    ordered = keyed.repartitionByRange("pivot", "dist", "id").sortWithinPartitions("pivot", "dist", "id")
    return ordered.select("id", "v", "pivot", "dist").mapInArrow(run, _QUERY if for_queries else _BLOCK)


def _search(pairs: DataFrame, pivots: np.ndarray, width: int, k: int) -> DataFrame:
    """The k best of each block for each query of a pair, but for what the bounds rule out."""

    def best(query: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other = ids != query
        ids, scores = ids[other], scores[other]
        if len(ids) > k:
            among = scores >= np.partition(scores, -k)[-k]
            ids, scores = ids[among], scores[among]
        order = np.lexsort((ids, -scores))[:k]
        return ids[order], scores[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                queries = np.frombuffer(pair["q_ids"], dtype=np.int64)
                q = np.frombuffer(pair["q_vectors"], dtype=np.int64).reshape(len(queries), width)
                ids = np.frombuffer(pair["ids"], dtype=np.int64)
                v = np.frombuffer(pair["vectors"], dtype=np.int64).reshape(len(ids), width)
                dists = np.frombuffer(pair["dists"], dtype=np.float64)
                floor = dict(zip(pair["f_ids"] or (), pair["f_scores"] or (), strict=True))
                # |q - v|^2 = |q|^2 + |v|^2 - 2 q.v, and |q - v| >= | |q - p| - |v - p| |
                norm2 = (q.astype(np.float64) ** 2).sum(1)
                from_pivot = np.sqrt(((q - pivots[pair["pivot"]]) ** 2).sum(1))
                reach2 = np.array([
                    n + pair["norm2"] - 2.0 * floor[x] if x in floor else np.inf
                    for n, x in zip(norm2, queries.tolist(), strict=True)
                ])
                slack = 1e-6 * (1.0 + norm2 + pair["norm2"])
                reach = np.sqrt(np.maximum(reach2 + slack, 0.0))
                low = np.searchsorted(dists, from_pivot - reach - 1e-6, "left")
                high = np.searchsorted(dists, from_pivot + reach + 1e-6, "right")
                live = np.flatnonzero((reach2 + slack >= 0) & (low < high))
                out: list[list] = [[], [], []]
                for at in range(0, len(live), 64):
                    some = live[at : at + 64]
                    a, b = int(low[some].min()), int(high[some].max())
                    scores = _scores(q[some], v[a:b])
                    for row, i in zip(scores, some, strict=True):
                        found, score = best(int(queries[i]), ids[low[i] : high[i]], row[low[i] - a : high[i] - a])
                        out[0] += [int(queries[i])] * len(found)
                        out[1] += found.tolist()
                        out[2] += score.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, type=pa.int64()) for x in out], names=["query_id", "vec_id", "score"]
                )

    given = pairs.select("q_ids", "q_vectors", "pivot", "norm2", "ids", "dists", "vectors", "f_ids", "f_scores")
    return given.mapInArrow(run, "query_id long, vec_id long, score long")


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    pivots: int = PIVOTS,
    pivot_sample: int = PIVOT_SAMPLE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors of highest inner product for each query.

    Every vector is keyed by its nearest pivot and its distance to it, and the sorted rows are
    cut into blocks. A block of queries first searches the annulus it lies in; the k-th score
    found there bounds how far a better vector can be. Annuli widen to that distance around every
    pivot (see ``_expand``), and of their blocks only those, and in them the rows, that the bound leaves
    are compared. Blocks meet by pivot and ring in an equality join. Bounds carry a
    slack for rounding; scores are whole numbers and exact. Ties go to the smaller id.

    ``is_query`` selects queries by the given columns. Rows with a null id or a vector that is
    null or has a null or non-finite component take no part; shorter vectors count as filled up
    with zeros; rows with the same id and vector count once; rows that share a query's id are
    its own and no candidates. A query with fewer than k candidates gets all. An empty table
    gives no rows, other columns are ignored.
    """
    rows = saved(
        vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
        .where("id IS NOT NULL AND v IS NOT NULL").distinct(),
        "vectors",
    )
    width = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(pivot_sample).select("v").collect()
    padded = np.zeros((len(sample), width))
    for i, row in enumerate(sample):
        padded[i, : len(row.v)] = row.v
    centres = choose_pivots(padded, pivots)

    keyed = _key_by_pivot(rows.select("id", "v"), centres, width)
    index = saved(_blocks(keyed, centres, width, block_rows, False), "index")
    asked = _key_by_pivot(rows.where("q").select("id", "v"), centres, width)
    queries = saved(
        _blocks(asked, centres, width, query_rows, True).withColumnsRenamed({"ids": "q_ids", "vectors": "q_vectors", "norm2": "q_norm2", "pivot": "q_pivot"}),
        "queries",
    )

    found = _expand(index, queries, centres, width, k)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _ring(distance: Column, ring: float) -> Column:
    """The ring around a pivot that a distance lies in; the last one has no end."""
    return F.greatest(F.lit(0), F.least(F.floor(distance / ring), F.lit(RINGS - 1))).cast("int")


def _expand(index: DataFrame, queries: DataFrame, centres: np.ndarray, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of the annuli around each pivot that can hold any of them.

    Blocks of both sides meet where they share a pivot and a ring of distances, in an equality join. The
    home annulus of a block of queries gives a first floor. Then annuli widen, by a share of the reach
    at first and by all of it at last: a vector whose score is above the floor is no farther from
    the query than the reach, so a pivot's other rings are left out; floors rise between the rounds.
    """
    edges = Window.partitionBy("pivot").orderBy("nearest", "block")
    about_index = index.select("block", "pivot", "nearest", "farthest", "norm2").withColumns({
        # Up to the next block, so that every distance is in some block's rings.
        "from": F.when(F.lag("block").over(edges).isNull(), 0.0).otherwise(F.col("nearest")),
        "to": F.coalesce(F.greatest(F.lead("nearest").over(edges), "farthest"), F.lit(float("inf"))),
    })
    about_index = saved(about_index, "about-index")
    whole = about_index.agg(F.max("farthest"), F.max("norm2")).first()
    ring, most_norm = max((whole[0] or 0.0) / RINGS, 1e-9), whole[1] or 0.0
    rings = about_index.withColumn("first_ring", _ring(F.col("from"), ring)).withColumn(
        "ring", F.explode(F.sequence("first_ring", _ring(F.col("to"), ring)))
    )
    about_queries = queries.select("qblock", "q_pivot", "near", "far", "q_norm2")
    payload = index.select("block", "pivot", "norm2", "ids", "dists", "vectors")
    asks = queries.select("qblock", "q_ids", "q_vectors")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(pairs: DataFrame, before: DataFrame | None) -> DataFrame:
        """The k best so far of each query, as a table."""
        new = _search(pairs.join(asks, "qblock").join(payload, "block"), centres, width, k)
        both = new if before is None else new.unionByName(before)
        best = both.distinct().withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k)
        return saved(best.select("query_id", "vec_id", "score"), "found")

    near, far = F.col("near")[F.col("q_pivot")], F.col("far")[F.col("q_pivot")]
    home = about_queries.select("qblock", F.col("q_pivot").alias("pivot"), near.alias("low"), far.alias("high")).withColumn(
        "ring", _ring((F.col("low") + F.col("high")) / 2, ring)
    )
    apart = F.greatest(F.lit(0.0), F.col("nearest") - F.col("high"), F.col("low") - F.col("farthest"))
    nearest = Window.partitionBy("qblock").orderBy("apart", "block")
    no_floor = [F.lit(None).cast("array<long>").alias(x) for x in ("f_ids", "f_scores")]
    done = saved(
        home.join(rings, ["pivot", "ring"]).withColumn("apart", apart)
        .withColumn("n", F.row_number().over(nearest)).where("n <= 2").select("qblock", "block"),
        "home",
    )
    found = searched(done.select("*", *no_floor), None)
    members = queries.select("qblock", "q_ids").mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_pylist(
                [{"qblock": r["qblock"], "query_id": int(x)} for r in b.to_pylist() for x in np.frombuffer(r["q_ids"], dtype=np.int64)],
                schema=pa.schema([("qblock", pa.int64()), ("query_id", pa.int64())]),
            )
            for b in batches
        ),
        "qblock long, query_id long",
    )
    members = saved(members.distinct(), "members")
    for share in REACHES:
        floors = (
            found.withColumn("n", F.row_number().over(ranked)).where(F.col("n") == k)
            .select("query_id", F.col("score").alias("floor"))
        )
        known = (
            members.join(floors, "query_id", "left").groupBy("qblock").agg(
                F.min(F.coalesce("floor", F.lit(-(2**62)))).alias("least"),
                F.collect_list(F.when(F.col("floor").isNotNull(), F.struct("query_id", "floor"))).alias("f"),
            )
            .select("qblock", "least", F.col("f.query_id").alias("f_ids"), F.col("f.floor").alias("f_scores"))
        )
        # |q - v|^2 = |q|^2 + |v|^2 - 2 q.v: where the floor is passed, at most the reach.
        room = F.col("q_norm2") + F.lit(most_norm) - 2.0 * F.col("least")
        slack = 1e-6 * (1.0 + F.col("q_norm2") + F.lit(most_norm))
        reach = F.sqrt(F.greatest(room + slack, F.lit(0.0))) * share + 1e-6
        around = (
            about_queries.join(known, "qblock").where(room + slack >= 0)
            .select("qblock", "q_norm2", "least", "far", reach.alias("reach"), F.posexplode("near").alias("pivot", "low"))
            .withColumn("high", F.col("far")[F.col("pivot")]).drop("far")
            .withColumn("q_first", _ring(F.col("low") - F.col("reach"), ring))
            .withColumn("ring", F.explode(F.sequence("q_first", _ring(F.col("high") + F.col("reach"), ring))))
        )
        room = F.col("q_norm2") + F.col("norm2") - apart * apart
        slack = 1e-6 * (1.0 + F.col("q_norm2") + F.col("norm2"))
        pairs = saved(
            around.join(rings, ["pivot", "ring"])
            .where(F.col("ring") == F.greatest("q_first", "first_ring"))  # once, in the first ring of both
            .where((room + slack >= 2.0 * F.col("least")) & (apart <= F.col("reach")))
            .select("qblock", "block").join(done, ["qblock", "block"], "left_anti"),
            "annuli",
        )
        if share == REACHES[-1] or not pairs.isEmpty():
            found = searched(pairs.join(known.select("qblock", "f_ids", "f_scores"), "qblock"), found)
            done = done.unionByName(pairs)
    return found
