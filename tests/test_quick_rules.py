"""Rules spelled for time find what their fixed patterns find; texts come to all cores."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from bugsieve.functions.dialect import java_pattern
from bugsieve.functions.rules import _LETTER, _LETTER_OR_DASH, _QUICKER, default_rules
from checks import corpus

RULES = {r.rule_id: r for r in default_rules()}
PIECES = {
    "ET-S02": [
        "[", "]", "\n", "[a]: ", "[b - c] - ", "A gate that stays open", " for a long while", " after", "\tWHEN", " \n on",
        " in", " throughout", "\x1c", " ", " when", ":", "after", "x" * 21, " ", "\n\n[z]-Q", " o", "İ",
    ],
}


@pytest.mark.parametrize("rule_id", _QUICKER)
def test_quicker_pattern_matches_the_same(spark, rule_id):
    rng, rule = random.Random(5), RULES[rule_id]
    texts = ["".join(rng.choices(PIECES[rule_id], k=rng.randint(2, 14))) for _ in range(6000)]
    texts += ["[a]: " + t for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def found(pattern, group):
        return F.regexp_extract_all("t", F.lit(java_pattern(pattern, rule.flags)), F.lit(group))

    assert rule.engine_pattern == _QUICKER[rule_id]
    both = df.select([found(p, g).alias(f"{k}{g}") for k, p in (("a", rule.pattern), ("b", rule.engine_pattern)) for g in (0, 1)])
    assert both.where("a0 <> b0 OR a1 <> b1").count() == 0
    assert both.where("size(a0) > 0").count() > 100


@pytest.mark.parametrize("written, folded", [(_LETTER, "[a-z]"), (_LETTER_OR_DASH, "[a-z-]")])
def test_letters_written_out_are_those_of_any_case(spark, written, folded):
    every = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    df = spark.createDataFrame([(every,)], "t string")
    a, b = (F.regexp_extract_all("t", F.lit(java_pattern(p, "i")), F.lit(0)) for p in (written, folded))
    assert df.select(a == b, F.size(a) > 52).first() == (True, True)


def test_texts_of_one_small_file_come_to_all_cores(spark, small):
    assert corpus.table(spark, small, "events").rdd.getNumPartitions() == 1
    cores = spark.sparkContext.defaultParallelism
    assert corpus.logs(spark, small).rdd.getNumPartitions() >= 4 * cores
    assert corpus.item_parts(spark, small).rdd.getNumPartitions() >= 4 * cores
    turns = corpus.table(spark, small, "conversations")
    assert corpus.spread_scan(turns, thin=False) is turns


def test_texts_are_those_of_the_reference(spark, tmp_path):
    kinds = ["error", "signup", "purchase", "view", None]
    rows = [(i, None, i % 9, kinds[i % 5]) for i in range(-80, 2400)] + [(None, None, 1, "error"), (5, None, None, "error")]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string")
    events.write.parquet(str(tmp_path / "events"))
    want = duckdb.sql(f"SELECT event_id, {corpus.LOG_TEXT} FROM '{tmp_path}/events/*.parquet'").fetchall()
    got = [tuple(r) for r in corpus.as_logs(events).select("event_id", "text").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
