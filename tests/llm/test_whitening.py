import math
import random

import numpy as np
import pytest

from bugsieve.llm import whitening as w


def fit_list(rows):
    return np.unique(np.floor(256 * np.array(rows, dtype=np.float64)), axis=0)


def dense(x):
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return values[::-1], vectors[:, ::-1], np.trace(y.T @ y) / len(x)


def check(frame, rows, ids=None):
    """Every row of the result against a dense decomposition."""
    x = fit_list(rows)
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    values, vectors, trace = dense(x)
    got = frame.collect()
    k = min(4, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == k * len(rows)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and r.identity_error <= 1e-4
    mean = np.array([s / n for s in sums])
    signs = {}
    for i, row in enumerate(rows):
        own = np.floor(256 * np.array(row, dtype=np.float64))
        exact = sum((n * int(a) - s) ** 2 for a, s in zip(own, sums, strict=True))
        assert sorted(by_row[i]) == list(range(1, k + 1))
        for c, r in by_row[i].items():
            assert r.deviation == exact
            assert math.isclose(r.explained, values[c - 1] / trace, rel_tol=1e-9)
            want = float((own - mean) @ vectors[:, c - 1]) / math.sqrt(values[c - 1])
            if abs(want) > 1e-3:
                sign = signs.setdefault(c, np.sign(want * r.whitened))
                assert math.isclose(r.whitened, sign * want, rel_tol=1e-7, abs_tol=1e-9)
    return got


def frame(spark, rows, parts=3):
    return spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>").repartition(parts)


def test_against_a_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    rows = (rng.standard_normal((150, 9)) * np.array([3, 2.5, 2, 1.2, 1, 1, 0.5, 0.2, 0.1])).astype(np.float32).tolist()
    rows += rows[:40] * 2  # copies count once in the fit, and each has its rows
    check(w.whiten(frame(spark, rows)), rows)


def test_the_given_vectors(spark, small):
    vectors = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding")
    rows = [r.embedding for r in vectors.orderBy("vec_id").collect()]
    ids = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    check(w.whiten(ids), rows)


@pytest.mark.parametrize("rank", [1, 2, 3])
def test_few_components(spark, rank):
    rng = np.random.default_rng(rank)
    rows = np.zeros((60, 6), dtype=np.float32)
    rows[:, :rank] = rng.integers(-8, 8, (60, rank))
    check(w.whiten(frame(spark, rows.tolist())), rows.tolist())


def test_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(a), float(b)] for a, b in ((1, 2), (3, -1), (0, 0), (-2, 5), (1, 2), (-0.001, 0.0))]
    odd = [None, [], [1.0], [None, 1.0], [nan, 1.0], [inf, 0.0], [-inf, 0.0]]
    rows = [(i, v, "x", 7) for i, v in enumerate(good)] + [(100 + i, v, "y", 8) for i, v in enumerate(odd)] + [(None, [1.0, 2.0], "z", 9)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, component int")
    out = w.whiten(docs)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == list(range(6))
    assert sum(r.vec_id is None for r in got) == 2 and {r.n for r in got} == {5}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert w.whiten(empty).collect() == []
    one = spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0])], "vec_id long, embedding array<float>")
    assert w.whiten(one).collect() == []


def test_deviations_are_exact():
    rng = np.random.default_rng(5)
    for top in (100, 2**19, 2**30):
        x = rng.integers(-top, top, (20, 7))
        n, sums = 10**6, [int(v) for v in rng.integers(-(2**50), 2**50, 7)]
        want = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
        assert w._deviations(x, n, sums) == [v if v < 2**63 else None for v in want]


@pytest.mark.parametrize("dim", [1, 2, 5, 30, 90])
def test_solver(dim):
    rng = np.random.default_rng(dim)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    for values in (np.sort(rng.random(dim))[::-1], np.ones(dim), np.r_[np.full(min(dim, 3), 2.0), np.linspace(1, 0, dim)[min(dim, 3):]]):
        a = q @ np.diag(values) @ q.T
        found, vectors, residuals = w.jacobi_davidson(lambda u, a=a: a @ u, dim, 4)
        k = min(dim, 4)
        assert np.allclose(found, np.sort(values)[::-1][:k], rtol=1e-12, atol=1e-13)
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
        assert residuals.max() <= 1e-12 * values.max()
        assert np.abs(a @ vectors - vectors * found).max() <= 1e-12


def test_minres():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a = a + a.T  # indefinite
    b = rng.standard_normal(12)
    solve = w._minres(b, 40, 1e-12)
    v = next(solve)
    try:
        while True:
            v = solve.send(a @ v)
    except StopIteration as end:
        assert np.allclose(a @ end.value, b, atol=1e-8)
