import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bugsieve.llm import topk


def brute(rows, k):
    usable = {}
    for name, vector in rows:
        if name is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.setdefault((name, tuple(math.floor(1024 * x) for x in vector)), None)
    out = []
    best = {}
    for name, q in usable:
        if name % 100:
            continue
        for other, v in usable:
            if other != name:
                best.setdefault(name, set()).add((-sum(a * b for a, b in zip(q, v, strict=False)), other))
    for name, found in best.items():
        out += [(name, i, other, -score) for i, (score, other) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def result(frame):
    return sorted(tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("block_rows,query_rows,pivots", [(4_096, 512, 32), (16, 3, 5), (1, 1, 1)])
def test_against_brute_force(spark, block_rows, query_rows, pivots):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * (1 + i % 3)).tolist()) for i in range(260)]
    rows += [(1_000 + i, rows[7][1]) for i in range(60)]  # a hot vector: ties
    rows += [(2_000, None), (2_100, [1.0, None] + [0.0] * 6), (2_200, [float("nan")] * 8), (2_300, [float("inf")] * 8),
             (2_400, [0.5, -0.25]), (2_500, []), (None, [1.0] * 8), (300, rows[0][1]), (300, rows[0][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.exact_top_k(
        frame, F.col("vec_id") % 100 == 0, block_rows=block_rows, query_rows=query_rows, pivots=pivots
    )
    assert result(got) == brute(exact, 10)


def test_few_candidates_large_numbers_and_none(spark):
    frame = spark.createDataFrame([(0, [3e5, 1e6]), (1, [1e6, 1.0]), (100, [0.0, 0.0])], "vec_id long, embedding array<double>")
    rows = [(r.vec_id, list(r.embedding)) for r in frame.collect()]
    assert result(topk.exact_top_k(frame, F.col("vec_id") % 100 == 0)) == brute(rows, 10)
    assert topk.exact_top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_rule_blocks_out(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 8)) * 50
    rows = [(i, (centres[i % 6] + rng.normal(size=8)).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(frame, F.col("vec_id") % 100 == 0, block_rows=20, query_rows=2, pivots=6)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert result(got) == brute(rows, 10)


def test_annuli_meet_by_pivot_and_ring(spark, monkeypatch):
    """Far clusters are never searched, and no step joins all blocks with all."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(8, 4)) * 1_000
    centres *= 1_000 / np.sqrt((centres**2).sum(1))[:, None]
    rows = [(i, (centres[i % 8] + rng.normal(size=4)).tolist()) for i in range(1_600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    searched, plans = [], []
    search = topk._search

    def counted(pairs, *rest):
        plans.append(pairs._jdf.queryExecution().optimizedPlan().toString() + pairs._jdf.queryExecution().executedPlan().toString())
        searched.append(pairs.select("qblock", "block").collect())
        return search(pairs, *rest)

    monkeypatch.setattr(topk, "_search", counted)
    got = topk.exact_top_k(frame, F.col("vec_id") % 100 == 0, block_rows=25, query_rows=2, pivots=8)
    assert result(got) == brute(rows, 10)
    assert not any("NestedLoop" in p or "Cartesian" in p for p in plans)
    pairs = [tuple(p) for part in searched for p in part]
    assert len(pairs) == len(set(pairs)) and len(pairs) <= 0.3 * 64 * 8
