import random

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.functions.rules import Rule, default_rules
from bugsieve.schema import FIELDS
from tests import bruteforce
from tests.test_rules import CASES

WORDS = (
    [c[0] for c in CASES.values()]
    + [c[2] for c in CASES.values()]
    + ["\n", "\n\n", " ", ". ", ": ", "Expected: ", "result: ", "1. go\n2. see", "x" * 300, "é NPE ü", "\t",
       "😀 users", "\x1c", "\xa0", "[2024-01-02T03:04:05Z] ERROR [svc-a] it broke\n", "----", "a-b-c-service "]
)


def generated(n, seed):
    rng = random.Random(seed)
    return [
        "".join(rng.choice(WORDS) + rng.choice(["", " ", "\n", "\n\n"]) for _ in range(rng.randint(0, 9)))
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def texts():
    fixed = ["", " \n ", "x", "result:", "Expected: ", "NPE " * 4, "y" * 2000 + " result: " + "z" * 1200]
    return fixed + generated(600, 7)


def test_fields_against_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(8)
    got = {r["i"]: r for r in bs.extract_all_fields(df).collect()}
    found = 0
    for i, text in enumerate(texts):
        for f in FIELDS:
            want = bruteforce.field(text, f)
            have = got[i][f]
            if want is None:
                assert have is None, (text, f)
                continue
            found += 1
            value, confidence, source, evidence, rule_id = want
            assert have["value"] == value, (text, f)
            assert have["raw_confidence"] == pytest.approx(confidence, abs=1e-12), (text, f)
            assert (have["source"], have["rule_id"]) == (source, rule_id), (text, f)
            assert have["raw_evidence"] == evidence, (text, f)
            assert have["confidence"] == bruteforce.score(confidence, source, len(value)), (text, f)
            assert len(have["raw_evidence"]) <= 500 and len(value) <= 1000
    assert found > 1000


def test_hits_against_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(8)
    got = {(r["i"], r["rule_id"]): (r["value"], r["matches"]) for r in bs.rule_hits(df).collect()}
    want = {(i, h[0].rule_id): (h[1], h[2]) for i, t in enumerate(texts) for h in bruteforce.hits(t)}
    assert got == want


def test_best_in_tier_agrees_with_extraction(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    best = bs.best_in_tier(bs.rule_hits(df), ["i"]).where("tier = 'strict' AND field = 'error_type'")
    a = {r["i"]: r["rule_id"] for r in best.collect()}
    found = bs.extract_field(df, "error_type").where("error_type.source = 'regex_strict'")
    assert a == {r["i"]: r["error_type"]["rule_id"] for r in found.collect()}


def test_custom_rules_against_brute_force(spark):
    rules = [
        Rule("A", "error_type", "strict", r"(a+)(b*)(c?)", "", 0.5),
        Rule("B", "error_type", "strict", r"x\w", "i", 0.6),
        Rule("C", "error_type", "strict", r"(\s*)y", "", 1.0),
        Rule("D", "error_type", "strict", r"(zz)", "", 1.0),
        Rule("E", "error_type", "loose", r"(q)", "", 0.0),
        Rule("F", "error_type", "loose", r"([\"'q]+)", "", 0.4),
        Rule("G", "component_module", "loose", r"(q)", "", 0.0),
    ]
    texts = ["abc", "aab xq xq", " y  y", "y zz abc", "zz zz xq", "q", "q q", "q q q 'x", '"', "", "xx abc abc abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r for r in bs.extract_all_fields(df, rules).collect()}
    for i, t in enumerate(texts):
        for f in FIELDS:
            want, have = bruteforce.field(t, f, rules), got[i][f]
            assert (have and (have["value"], have["rule_id"])) == (want and (want[0], want[4])), (t, f)


def test_unknown_field_is_refused(spark):
    with pytest.raises(ValueError):
        bs.extract_fields(spark.createDataFrame([("x",)], "text string"), ["nope"])


def plan_of(spark, df):
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def staging(spark):
    return spark.createDataFrame([("x", "a")], "text string, part string").select(
        "text", "part",
        F.struct(F.lit("freetext").alias("source_type"), F.lit("a").alias("source_id")).alias("source_metadata"),
    )


def test_one_field_runs_its_own_rules_only(spark):
    plan = plan_of(spark, bs.extract_field(staging(spark), "expected_behavior"))
    assert plan.count("regexp_extract_all") == len([r for r in default_rules() if r.field == "expected_behavior"])


@pytest.mark.parametrize("options", [{}, {"enable_enrichment": True}, {"id_mode": "content"}])
def test_plan_has_no_shuffle_and_one_matcher_per_rule(spark, options):
    bugs = bs.normalize(staging(spark), keep=["part"], **options)
    # One matcher per rule; the rule with two groups has two. Filters do not repeat them.
    for df in (
        bugs,
        bugs.where("overall_confidence > 0.5"),
        bugs.where("error_type.confidence > 0.5 AND expected_behavior.value IS NOT NULL"),
        bs.validate_bugs(bugs)[0],
    ):
        plan = plan_of(spark, df)
        assert plan.count("regexp_extract_all") == 81
        assert "Exchange" not in plan and "Python" not in plan


def test_filter_on_a_carried_column_reaches_the_scan(spark, tmp_path):
    staging(spark).write.parquet(str(tmp_path / "s"))
    bugs = bs.normalize(spark.read.parquet(str(tmp_path / "s")), keep=["part"], id_mode="content")
    assert "EqualTo(part,b)" in plan_of(spark, bugs.where("part = 'b'"))


def test_no_fields_is_refused(spark):
    with pytest.raises(ValueError):
        bs.extract_fields(staging(spark), [])
