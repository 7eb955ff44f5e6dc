import pytest
from pyspark.sql import functions as F

from bugsieve.functions import scoring
from bugsieve.functions.rules import default_rules
from tests import bruteforce


@pytest.mark.parametrize(
    "base, source, evidence, length, want",
    [
        (0.9, "regex_strict", True, 50, 0.905),
        (0.9, "regex_loose", True, 50, 0.68),
        (0.7, "rule_based", False, 10, 0.595),
        (0.95, "regex_strict", True, 3, 0.762),
        (0.93, "regex_strict", True, 50, 0.933),
        (0.5, "something", False, 9, 0.25),
    ],
)
def test_scored(base, source, evidence, length, want):
    assert scoring.scored(base, source, evidence, length) == want
    assert bruteforce.score(base, source, length, evidence) == want


def test_column_equals_plain_numbers(spark):
    sources = [*scoring.SOURCE_WEIGHTS, "other"]
    bases = sorted({scoring.boosted(r.base, n) for r in default_rules() for n in (1, 2, 3, 4)} | {i / 200 for i in range(201)})
    rows = [(b, s, e, n) for b in bases for s in sources for e in (True, False) for n in (0, 4, 5)]
    df = spark.createDataFrame(rows, "b double, s string, e boolean, n int")
    got = df.select(
        "*", scoring.score_field(F.col("b"), F.col("s"), F.col("e"), F.col("n")).alias("c")
    ).collect()
    for r in got:
        assert r["c"] == scoring.scored(r["b"], r["s"], r["e"], r["n"]), r
        assert r["c"] == bruteforce.score(r["b"], r["s"], r["n"], r["e"]), r


def test_boost(spark):
    rows = [(b / 100, n) for b in range(0, 101, 5) for n in (1, 2, 3, 4, 9)]
    df = spark.createDataFrame(rows, "b double, n int")
    for r in df.select("*", scoring.occurrence_boost(F.col("b"), F.col("n")).alias("c")).collect():
        assert r["c"] == scoring.boosted(r["b"], r["n"])
    assert scoring.boosted(0.85, 3) > scoring.boosted(0.95, 1)


def test_levels_and_threshold(spark):
    df = spark.createDataFrame([(0.95,), (0.75,), (0.45,), (0.85,), (0.25,), (0.8,), (0.5,)], "c double")
    got = df.select(
        scoring.confidence_level(F.col("c")), scoring.needs_enrichment(F.col("c")),
        scoring.needs_enrichment(F.col("c"), 0), scoring.needs_enrichment(F.col("c"), 0.8),
    ).collect()
    assert [r[0] for r in got] == ["high", "medium", "low", "high", "low", "high", "medium"]
    assert [r[1] for r in got] == [r[2] for r in got] == [False, False, True, False, True, False, False]
    assert [r[3] for r in got] == [False, True, True, False, True, False, True]
