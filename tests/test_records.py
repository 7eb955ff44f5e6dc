import json

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.schema import FIELDS, RECORD
from tests import bruteforce
from tests.test_extract import generated

# Five rules, one a field, in sections that end at blank lines.
FULL = (
    "Acceptance criteria: one ring per stop\n\nHow to reproduce: board at the mill, pull the cord\n\n"
    "Outcome: two rings, then none\n\nMemory leak detected in module tram.bell"
)

# Stamped lines with a stack frame among them; the strict and the loose tier both have hits.
LOG = "\n".join([
    "boot of the weir, build 9",
    "[2040-02-29T00:00:05Z] INFO [lamp-room] warm",
    "[2040-02-29T00:00:09Z] WARN [sluice] slow by a third, limit: 40 litres a second",
    "   at mill.race.Wheel(Wheel.java:7)",
    "[2040-02-29T00:01:00Z] CRITICAL [mill-race] Memory usage critical",
    "[2040-02-29T00:01:02Z] CRITICAL [mill-race] Wheel stands still",
    "31 users affected, millers mostly",
])

# A text that one rule of the table hits, and the value it captures.
SINGLE = {
    "ET-S16": ("a plain 403 Forbidden at the gate", "403"),
    "ET-L02": ("the error rate exceeded threshold by noon", "error rate exceeded threshold by noon"),
    "ET-L04": ("the crane was unable to swing", "unable to swing"),
    "CM-S03": ("Tool: Rope Winder Build 7", "Rope Winder"),
    "CM-S05": ("Portal: https://tickets.canal.example/x", "tickets.canal.example"),
    "CM-L05": ("ask the LockManager", "LockManager"),
    "CM-L07": ("upstream service: weir-db", "weir-db"),
    "RS-S04": ("1) lift the bar\n2) let it fall", "1) lift the bar\n2) let it fall"),
    "RS-L03": ("if you turn left at the lock.", "turn left at the lock"),
    "OB-S03": ("Customer impact: no bread today", "Customer impact: no bread today"),
    "OB-L02": ("a boat, but: no water", "no water"),
    "EX-L03": ("ran correctly, all night", "all night"),
}


def free(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    return bs.read_freetext(df, keep=("k",))


def records(spark, *texts, **options):
    rows = bs.normalize(free(spark, *texts), keep=["k"], **options).collect()
    return [r for r in sorted(rows, key=lambda r: r["k"])]


def short(record, f):
    return record[f]["value"], record[f]["confidence"]


def test_schema(spark):
    bugs = bs.normalize(free(spark, "x"))
    assert bugs.dtypes == [(f.name, f.dataType.simpleString()) for f in RECORD]
    ado = bs.read_ado(spark.createDataFrame([('{"id": "1", "fields": {}}',)], "json string"))
    assert bs.normalize(ado).dtypes == bugs.dtypes


def test_one_rule_at_a_time(spark):
    table = {r.rule_id: r for r in bs.default_rules()}
    got = records(spark, *[text for text, _ in SINGLE.values()])
    for r, (rule_id, (_, value)) in zip(got, SINGLE.items(), strict=True):
        rule = table[rule_id]
        score = bruteforce.score(rule.base, f"regex_{rule.tier}", len(value))
        assert short(r, rule.field) == (value, score), rule_id
        assert r[rule.field]["source"] == f"regex_{rule.tier}"
        assert all(short(r, f) == (None, 0.0) for f in FIELDS if f != rule.field), rule_id
        assert r["overall_confidence"] == pytest.approx(score / 5, abs=1e-9)
        assert r["fields_extracted_by_regex"] == 1


def test_no_rule_hits(spark):
    for r in records(spark, "", "quiet on the canal"):
        assert all(short(r, f) == (None, 0.0) for f in FIELDS)
        assert (r["overall_confidence"], r["fields_extracted_by_regex"], r["total_extractable_fields"]) == (0.0, 0, 5)
        assert r["severity"] is None


def test_sections(spark):
    (r,) = records(spark, FULL)
    assert [short(r, f) for f in FIELDS] == [
        ("Memory leak detected", 0.953), ("tram.bell", 0.905), ("board at the mill, pull the cord", 0.905),
        ("two rings, then none", 0.858), ("one ring per stop", 0.905),
    ]
    assert r["overall_confidence"] == pytest.approx(0.9052) and r["fields_extracted_by_regex"] == 5


def test_stamped_lines(spark):
    (r,) = records(spark, LOG)
    # The stamped rule outranks the memory rule, and two hits outrank one; the stack frame ranks below both.
    assert short(r, "error_type") == ("Memory usage critical", 1.0)
    assert short(r, "component_module") == ("mill-race", 1.0)
    # The frame breaks the run of stamped lines, and no CRITICAL line belongs to one.
    assert short(r, "trigger_repro_steps") == ("\n".join(LOG.split("\n")[1:3]), 0.47)
    assert r["trigger_repro_steps"]["source"] == "regex_loose"
    assert short(r, "observed_behavior") == ("31 users affected, millers mostly", 0.905)
    assert short(r, "expected_behavior") == ("40 litres a second", 0.435)
    assert r["overall_confidence"] == pytest.approx(0.762)


def test_work_items(spark):
    fields = {
        "only html": {"System.Description": "<ul><li>Cascade failure</li><li>services degraded: barge-line</li></ul>"},
        "only steps": {"Microsoft.VSTS.TCM.ReproSteps": "<div>lower the bridge</div>"},
        "only criteria": {"Microsoft.VSTS.Common.AcceptanceCriteria": "The gate must close before the bell"},
        "title": {"System.Title": "Queue overflow, queue overflow, queue overflow", "System.State": "New"},
    }
    rows = [(json.dumps({"id": name, "fields": f}),) for name, f in fields.items()]
    staging = bs.read_ado(spark.createDataFrame(rows, "json string"))
    texts = {r["source_metadata"]["source_id"]: r["text"] for r in staging.collect()}
    got = {r["source_metadata"]["source_id"]: r for r in bs.normalize(staging).collect()}
    assert set(got) == {f"ado_{name}" for name in fields}
    for key, r in got.items():
        want, overall = bruteforce.record(texts[key])
        assert [short(r, f) for f in FIELDS] == [want[f][:2] for f in FIELDS]
        assert r["overall_confidence"] == pytest.approx(overall, abs=1e-9)
    assert got["ado_only html"]["error_type"]["value"].startswith("Cascade failure")
    assert got["ado_only html"]["component_module"]["value"] == "barge-line"
    assert got["ado_only steps"]["trigger_repro_steps"]["value"] == "lower the bridge"
    assert got["ado_only criteria"]["expected_behavior"]["value"] == "The gate must close before the bell"
    assert short(got["ado_title"], "error_type") == ("Queue overflow", 1.0)  # three hits


def test_fields_not_asked_for_run_no_rules(spark):
    staging = free(spark, LOG, FULL)
    some = bs.normalize(staging, fields=["error_type"])
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    rules = [r for r in bs.default_rules() if r.field == "error_type"]
    assert plan.count("regexp_extract_all") == sum(max(1, r.groups) for r in rules)
    full = {r["error_type"]["value"] for r in bs.normalize(staging).collect()}
    rows = some.collect()
    assert {r["error_type"]["value"] for r in rows} == full
    assert all(short(r, f) == (None, 0.0) for r in rows for f in FIELDS[1:])


def test_records_against_brute_force(spark):
    texts = [t.strip() for t in generated(250, 23)]
    staging = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select(
        "k", "text",
        F.struct(F.lit("freetext").alias("source_type"), F.lit("s").alias("source_id")).alias("source_metadata"),
    )
    for r in bs.normalize(staging, keep=["k"]).collect():
        want, overall = bruteforce.record(texts[r["k"]])
        for f in FIELDS:
            assert (r[f]["value"], r[f]["confidence"], r[f]["source"], r[f]["raw_evidence"]) == want[f]
        assert r["overall_confidence"] == pytest.approx(overall, abs=1e-12)


def test_row_order_does_not_matter(spark):
    texts = generated(60, 3)
    keep = ["k", *[f"{f}.value" for f in FIELDS], "overall_confidence"]
    one = bs.normalize(free(spark, *texts), keep=["k"]).select(keep).collect()
    two = bs.normalize(free(spark, *texts).orderBy(F.rand(1)).repartition(5), keep=["k"]).select(keep).collect()
    assert sorted(one, key=lambda r: r["k"]) == sorted(two, key=lambda r: r["k"])


def test_ids(spark):
    def ids(**options):
        return [r["bug_id"] for r in records(spark, "a", "b", "a", **options)]

    a, b, c = ids(id_mode="content")
    assert a == c != b and ids(id_mode="content") == [a, b, c] and len(a) == 64
    assert len(set(ids())) == 3 and all(len(i) == 36 for i in ids())
    with pytest.raises(ValueError):
        bs.normalize(free(spark, "a"), id_mode="x")


def test_enrichment(spark):
    r, full = records(spark, LOG, FULL, enable_enrichment=True)
    assert short(r, "expected_behavior") == ("[NLP-inferred] System should not 31 users affected, millers mostly", 0.5)
    assert r["expected_behavior"]["source"] == "nlp_enriched"
    assert r["expected_behavior"]["raw_evidence"] == LOG[:500]
    assert (r["fields_enriched_by_nlp"], r["nlp_enrichment_applied"], r["fields_extracted_by_regex"]) == (1, True, 5)
    assert short(r, "trigger_repro_steps")[1] == 0.47
    assert r["overall_confidence"] == pytest.approx((1 + 1 + 0.47 + 0.905 + 0.5) / 5)
    assert (full["fields_enriched_by_nlp"], full["nlp_enrichment_applied"]) == (0, False)
    (none,) = records(spark, "nothing here", enable_enrichment=True)
    assert (none["fields_enriched_by_nlp"], none["nlp_enrichment_applied"]) == (0, True)
    # A higher threshold also replaces a good value.
    (strict,) = records(spark, FULL, enable_enrichment=True, threshold=0.95)
    assert short(strict, "expected_behavior") == ("[NLP-inferred] System should not two rings, then none", 0.5)


def test_custom_enricher_sees_weak_rows_only(spark):
    def infer(field, text, observed):
        assert not (field == "error_type").any()
        assert text.notna().all()
        return (field + "|" + text + "|" + observed.fillna("none")).where(~text.str.contains("skip"), "")

    custom = bs.vectorized_enricher(infer, fields=("observed_behavior", "expected_behavior"))
    a, b, c = records(spark, "NPE", FULL, "skip", enable_enrichment=True, enricher=custom)
    assert a["observed_behavior"]["value"] == "observed_behavior|NPE|none"
    # The replaced observed behavior is what the next field sees.
    assert a["expected_behavior"]["value"] == "expected_behavior|NPE|observed_behavior|NPE|none"
    assert a["fields_enriched_by_nlp"] == 2
    assert b["fields_enriched_by_nlp"] == 0
    assert (c["observed_behavior"]["value"], c["fields_enriched_by_nlp"]) == (None, 0)


def test_validation(spark):
    bugs = bs.normalize(free(spark, FULL, "x", LOG), keep=["k"])
    good, bad = bs.validate_bugs(bugs)
    assert (good.count(), bad.count()) == (3, 0)
    broken = bugs.withColumn(
        "error_type", F.when(F.col("k") == 1, F.col("error_type").withField("confidence", F.lit(2.0))).otherwise(F.col("error_type"))
    ).withColumn("observed_behavior", F.col("observed_behavior").withField("raw_evidence", F.repeat(F.lit("x"), F.when(F.col("k") == 2, 501).otherwise(500))))
    good, bad = bs.validate_bugs(broken)
    assert good.count() == 1 and "violations" not in good.columns
    assert {r["k"]: r["violations"] for r in bad.collect()} == {
        1: ["error_type.confidence"], 2: ["observed_behavior.raw_evidence"],
    }


def test_json_sink(spark, tmp_path):
    bugs = bs.normalize(free(spark, LOG, "plain"))
    bs.write_bugs(bugs, str(tmp_path / "j"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert len(lines) == 2
    for o in lines:
        assert list(o) == RECORD.fieldNames()
        assert list(o["error_type"]) == ["value", "confidence", "source", "raw_evidence", "extraction_timestamp"]
        assert o["severity"] is None and o["source_metadata"]["file_name"] is None
    assert len(bs.to_json(bugs).collect()) == 2
    bs.write_bugs(bugs, str(tmp_path / "p"), format="parquet", by_source_type=True)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.where("source_type = 'freetext'").count() == 2
    with pytest.raises(ValueError):
        bs.write_bugs(bugs, str(tmp_path / "x"), format="xml")


def test_reports(spark):
    staging = free(spark, FULL, "NPE", None, LOG, "x" * 10_001)
    _, rejects = bs.split_rejects(staging)
    bugs = bs.normalize(staging)
    s = bs.batch_stats(bugs).first()
    assert (s["total_processed"], s["high_confidence"], s["medium_confidence"], s["low_confidence"]) == (3, 1, 1, 1)
    r = bs.run_stats(bugs, rejects).first()
    assert (r["succeeded"], r["failed"], r["total"]) == (3, 2, 5)
    assert r["max_confidence"] == pytest.approx(0.9052) and r["high_pct"] == pytest.approx(100 / 3)
    e = bs.field_extraction_rate(bugs).first()
    assert (e["fields_extracted"], e["fields_possible"]) == (11, 15)
    assert bs.failed_items(rejects).count() == 2
    q = {(x["field"], x["level"]): x["fields"] for x in bs.field_quality_distribution(bugs).collect()}
    assert len(q) == 18 and sum(n for (f, _), n in q.items() if f == "all") == 15
    assert q[("error_type", "high")] == 2 and q[("error_type", "medium")] == 1
    m = {x["metric"]: x for x in bs.monitoring_metrics(bugs).collect()}
    assert m["mean_fields_by_rules"]["value"] == pytest.approx(11 / 3)
    assert m["enrichment_success_rate"]["value"] is None and not m["enrichment_success_rate"]["alert"]
    assert bs.extraction_events(bugs).count() == 15
    assert bs.pipeline_events(bugs).where("source_type = 'freetext'").count() == 3
    shown = {x["error_type"]: x for x in bs.bug_summary(bugs).collect()}
    assert shown["NPE"]["component_module"] == "[NOT DETECTED]" and shown["NPE"]["fields_extracted"] == "1/5"
    assert shown["NPE"]["low_confidence_fields"] == "component_module, trigger_repro_steps, observed_behavior, expected_behavior"
    assert max(len(x["trigger_repro_steps"]) for x in shown.values()) == 103


def test_empty_batch(spark):
    bugs = bs.normalize(free(spark, None))
    s = bs.batch_stats(bugs).first()
    assert (s["total_processed"], s["mean_confidence"]) == (0, None)
    assert bs.run_stats(bugs, bs.split_rejects(free(spark, None))[1]).first()["failed"] == 1
    assert {x["share_pct"] for x in bs.field_quality_distribution(bugs).collect()} == {None}


def test_merge(spark):
    keep = ["incident"]
    rows = [("i1", LOG), ("i1", FULL), ("i2", "NPE"), ("i2", "nothing"), ("i1", FULL), (None, "NPE"), (None, "in module sluice.gear")]
    staging = spark.createDataFrame(rows, "incident string, text string").select(
        "text", F.struct(F.lit("freetext").alias("source_type"), F.lit("s").alias("source_id")).alias("source_metadata"), "incident"
    )
    merged = bs.merge_evidence(bs.normalize(staging, keep=keep), "incident").collect()
    got = {r["incident"]: r for r in merged if r["incident"]}
    alone = [r for r in merged if r["incident"] is None]  # strangers stay apart
    assert sorted((r["records"], r["error_type"]["value"], r["component_module"]["value"]) for r in alone if r["error_type"]["value"]) == [(1, "NPE", None)]
    assert [(r["records"], r["component_module"]["value"]) for r in alone if not r["error_type"]["value"]] == [(1, "sluice.gear")]
    assert got["i1"]["records"] == 3
    assert got["i1"]["error_type"]["value"] == "Memory usage critical"
    assert got["i1"]["trigger_repro_steps"]["value"] == "board at the mill, pull the cord"
    assert got["i1"]["expected_behavior"]["value"] == "one ring per stop"
    assert got["i2"]["component_module"]["value"] is None
    assert got["i2"]["overall_confidence"] == pytest.approx(0.762 / 5)


def test_split(spark):
    text = "NPE here\n==========\n\nfirst\n===========  \nsecond\n=====\nstill second\n================"
    staging = spark.createDataFrame([(text,)], "text string").select(
        "text", F.struct(F.lit("error_log").alias("source_type"), F.lit("f").alias("source_id")).alias("source_metadata")
    )
    got = bs.split_reports(staging).orderBy("source_metadata.source_id").collect()
    assert [(r["source_metadata"]["source_id"], r["text"].strip()) for r in got] == [
        ("f#1", "NPE here"), ("f#2", "first"), ("f#3", "second\n=====\nstill second"),
    ]
    assert got[0]["source_metadata"]["raw_text_length"] == len(got[0]["text"])
