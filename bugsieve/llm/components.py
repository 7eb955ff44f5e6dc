"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bugsieve.llm.common import saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("a"),
        F.bit_xor(F.xxhash64("v", "u")).alias("b"),
    ).first()
    return tuple(row)


def component_labels(edges: DataFrame) -> DataFrame:
    """(u, v) for each node u that is not its component's smallest node v.

    ``edges`` has two long columns ``a`` and ``b``. Large-star and small-star steps alternate:
    every node hooks its larger neighbours, then its smaller ones, to the smallest neighbour it
    knows, until each component is a star. Minima are combined before the shuffle, so a node
    with a third of all edges costs one row a task; each round is a table in the shared folder.
    No edges give no rows; self-loops and repeated edges change nothing.
    """
    now = saved(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        )
        large = saved(large.distinct(), "large")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = (
            large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        now = saved(hooked.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small")
        before, state = state, _state(now)
        if state == before:
            break
    return now
