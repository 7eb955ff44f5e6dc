import random
import re

import pytest
from pyspark.sql import functions as F

import bugsieve as bs
from bugsieve.functions.dialect import java_pattern
from bugsieve.functions.rules import _STACK_SAFE, Rule, check_rules, default_rules
from bugsieve.functions.text import fold_case
from bugsieve.operators.extract import _FOLDED, _found_words, _search_form, _words, _worth_trying

BY_ID = {r.rule_id: r for r in default_rules()}

# rule id: (text that hits, value, near miss)
CASES = {
    "ET-S01": ("[2024-01-01T00:00Z] ERROR [a] Disk is full: x\nz", "Disk is full: x", "[2024-01-01 00:00] ERROR [a] Disk"),
    "ET-S02": ("[Area]: Totals are wrong on the page after saving\n", "Totals are wrong on the page", "[Area]: short one after\n"),
    "ET-S03": ("the Screen Reader has an issue with it. x", "Screen Reader has an issue with it", "Screen Reader works"),
    "ET-S04": ("JAWS is reading twice. x", "JAWS is reading twice", "JAWS is silent"),
    "ET-S05": ("Accessibility problem here. x", "Accessibility problem here", "Accessibility is fine"),
    "ET-S06": ("Program fails to open it. x", "Program fails to open it", "Program fails to print"),
    "ET-S07": ("a npe here", "npe", "npex"),
    "ET-S08": ("IndexOutOfBoundsException:", "IndexOutOfBoundsException", "ArrayIndexOutOfBoundsExceptions"),
    "ET-S09": ("SQLException x", "SQLException", "MySQLException"),
    "ET-S10": ("TimeoutException", "TimeoutException", "TimeoutExceptions"),
    "ET-S11": ("connectionrefusedexception", "connectionrefusedexception", "ConnectionRefused"),
    "ET-S12": ("FileNotFoundException", "FileNotFoundException", "FileNotFound"),
    "ET-S13": ("went out of memory now", "out of memory", "out of  memory"),
    "ET-S14": ("StackOverflowError", "StackOverflowError", "StackOverflow"),
    "ET-S15": ("code 503 Gateway Timeout", "503", "code 603 Timeout"),
    "ET-S16": ("404 Not Found", "404", "404 Missing"),
    "ET-S17": ("Connection pool exhausted", "Connection pool exhausted", "pool exhausted"),
    "ET-S18": ("connection  timeout", "connection  timeout", "connection was timeout"),
    "ET-S19": ("circuit breaker triggered", "circuit breaker triggered", "circuit breaker open"),
    "ET-S20": ("service dependency unavailable", "service dependency unavailable", "service was unavailable"),
    "ET-S21": ("memory usage critical", "memory usage critical", "memory usage high"),
    "ET-S22": ("Memory leak detected", "Memory leak detected", "memory leak found"),
    "ET-S23": ("cascade failure", "cascade failure", "cascading failure"),
    "ET-S24": ("database connection failed", "database connection failed", "database connection ok"),
    "ET-S25": ("endpoint timeouts detected", "endpoint timeouts detected", "endpoint timeout seen"),
    "ET-S26": ("request processing failed", "request processing failed", "request failed"),
    "ET-S27": ("health status degraded", "health status degraded", "health is degraded"),
    "ET-S28": ("queue overflow", "queue overflow", "queue is full"),
    "ET-L01": ("error [svc] it broke: x", "it broke", "error svc it broke"),
    "ET-L02": ("error rate exceeded threshold of\n5. x", "error rate exceeded threshold of\n5", "error rate exceeded 5"),
    "ET-L03": ("failed to save: x", "failed to save", "failed saving"),
    "ET-L04": ("unable to save. x", "unable to save", "unable, sorry"),
    "ET-L05": ("it timed out", "timed out", "timeouts"),
    "ET-L06": ("it crashed", "crashed", "crashes"),
    "ET-L07": ("now degraded", "degraded", "degradedly"),
    "CM-S01": ("[My ServiceNow Page] x", "My ServiceNow Page", "[ServiceNow] x"),
    "CM-S02": ("[Billing Tool - x]", "Billing Tool", "[1Billing - x]"),
    "CM-S03": ("Product: Ledger Pro, x", "Ledger Pro", "Product: Led"),
    "CM-S04": ("Screen Readers: NVDA 2021 - x", "NVDA 2021", "Screen Readers: NV"),
    "CM-S05": ("Portal: https://a.b-c.org/x", "a.b-c.org", "Portal a.b"),
    "CM-S06": ("error [a-b_9]", "a-b_9", "error [9a]"),
    "CM-S07": ("CRITICAL [db]", "db", "CRITICAL [d b]"),
    "CM-S08": ("warn [x1]", "x1", "warning [x1]"),
    "CM-S09": ("unresponsive: my-service", "my-service", "unresponsive: myservice"),
    "CM-S10": ("x 9my-a-service status", "my-a-service", "my-service is status"),
    "CM-S11": ("services degraded: a-b-, x", "a-b-", "services are degraded: a"),
    "CM-S12": ("in module 'a.b_c' x", "a.b_c", "in the module a"),
    "CM-S13": ("at a.b.C.run(C.java)", "a.b.C run", "at run(C.java)"),
    "CM-S14": ("in the MailHandler", "MailHandler", "in the mail"),
    "CM-S15": ('component: "cart-x.y"', "cart-x.y", "a part: cart"),
    "CM-L01": ("see foo-bar-baz-service-x", "foo-bar-baz-service", "see foo-service"),
    "CM-L02": ("the foo-bar error", "foo-bar", "the foo-bar is"),
    "CM-L03": ("MailService", "MailService", "mailService"),
    "CM-L04": ("HomeController", "HomeController", "homeController"),
    "CM-L05": ("InventoryManager", "InventoryManager", "inventory Managers"),
    "CM-L06": ("EventHandler", "EventHandler", "EventHandlers"),
    "CM-L07": ("upstream service: ledger-x", "ledger-x", "upstream: ledger"),
    "RS-S01": ("Steps to reproduce: a\nb\n\nc", "a\nb", "Steps: a"),
    "RS-S02": ("to reproduce: a actual b", "a", "reproduced: a"),
    "RS-S03": ("repro: a actual b", "a actual b", "reproduce: a"),
    "RS-S04": ("x\n1. a\n2) b\nc", "1. a\n2) b", "1. a\nb"),
    "RS-L01": ("when clicking it twice. x", "it twice", "when it clicks"),
    "RS-L02": ("go to page two. x", "page two", "goto page"),
    "RS-L03": ("if you: press. x", "press", "if they press"),
    "RS-L04": ("[2024-1] INFO a\n[2024-1] WARN b\nx", "[2024-1] INFO a\n[2024-1] WARN b", "[2024-1] INFO a\n[2024-1] CRITICAL b"),
    "OB-S01": ("Actual result: a\nb expected c", "a\nb", "Actual: a"),
    "OB-S02": ("Expected Result: a\n\nb", "a", "results a"),
    "OB-S03": ("user impact: all\nx", "user impact: all", "user impacts: all"),
    "OB-S04": ("12 users affected now\nx", "12 users affected now", "users affected"),
    "OB-L01": ("ERROR [a] job failed now. x", "job failed now", "ERROR [a] job done"),
    "OB-L02": ("but: it stays. x", "it stays", "butter stays"),
    "OB-L03": ("returns: nothing. x", "nothing", "returned nothing"),
    "OB-L04": ("application crashes often. x", "application crashes often", "app crashes"),
    "OB-L05": ("service is down now. x", "service is down now", "service goes down"),
    "EX-S01": ("should be: a\nb\n\nc", "a\nb", "should go: a"),
    "EX-S02": ("Acceptance criteria: a\n\nb", "a", "criteria: a"),
    "EX-L01": ("must return a sum. x", "return a sum", "must go"),
    "EX-L02": ("we want: a sum. x", "a sum", "unwanted sum"),
    "EX-L03": ("normally, it stays. x", "it stays", "normal, it stays"),
    "EX-L04": ("SLA: 99 percent. x", "99 percent", "SLA: none"),
}


def test_every_rule_has_a_case():
    assert set(CASES) == set(BY_ID) and len(BY_ID) == 80


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = [(i, "hit", c[0]) for i, c in CASES.items()] + [(i, "miss", c[2]) for i, c in CASES.items()]
    df = spark.createDataFrame(rows, "id string, kind string, text string")
    got = bs.rule_hits(df).where(F.col("id") == F.col("rule_id")).collect()
    return {(r["id"], r["kind"]): r["value"] for r in got}


@pytest.mark.parametrize("rule_id", list(CASES))
def test_rule(outcomes, rule_id):
    assert outcomes.get((rule_id, "hit")) == CASES[rule_id][1]
    assert (rule_id, "miss") not in outcomes


def test_counts_per_field_and_tier(spark):
    got = {r["field"]: (r["strict"], r["loose"]) for r in bs.registry_counts(spark).collect()}
    assert got == {
        "error_type": (28, 7), "component_module": (15, 7), "trigger_repro_steps": (4, 4),
        "observed_behavior": (4, 5), "expected_behavior": (2, 4),
    }
    assert bs.rules_df(spark).count() == 80


PIECES = {
    "CM-S06": ["ERROR ", "error\t", "[", "]", "a-b", "a", "9", "-", "_", " ", "x--y"],
    "CM-S07": ["CRITICAL ", "[", "]", "a-b", "a", "9", "-", "_", " "],
    "CM-S08": ["WARN ", "[", "]", "a-b", "a", "9", "-", "_", " "],
    "CM-S10": ["a", "-", "9", "_", "-service", " ", "unavailable", "status", "\n", "b-service", "é"],
    "CM-S11": ["services degraded", "service  degraded", ": ", "a", "-b", "-", "9", " ", "-9"],
    "CM-L01": ["a", "-", "b", "service", "-service", " ", "9", "_", "--", "c-d"],
    "CM-L02": ["a", "-b", "-", " ", "status", "error", " unavailable", "9", "degraded"],
    "OB-L01": ["ERROR", "critical", "]", " ", "[", "x", "failed", "timeout", ":", ".", "\n", " error", "] y failed"],
    "RS-S04": ["1.", "2)", "3. ", " ", "  ", "\n", "x", "1) ", "\n1. a", "\n2. b", "\t"],
    "RS-L04": ["[2024-1]", " ", "ERROR", "WARN x", "INFO", "\n", "x", "[2024-", "]", "[2024-1] ERROR y", "CRITICAL"],
}


def test_every_rewritten_rule_is_covered():
    assert set(PIECES) == set(_STACK_SAFE)


@pytest.mark.parametrize("rule_id", list(PIECES))
def test_rewritten_pattern_matches_the_same(spark, rule_id):
    """On the JVM, where the rewritten patterns run."""
    rule = BY_ID[rule_id]
    rng = random.Random(rule_id)
    pieces = PIECES[rule_id]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def found(pattern):
        return F.regexp_extract_all("t", F.lit(java_pattern(pattern, rule.flags)), F.lit(1))

    both = df.select("t", found(rule.pattern).alias("a"), found(rule.engine_pattern).alias("b"))
    assert both.where("a <> b").take(3) == []
    assert both.where("size(a) > 0").count() > 20


def test_prefilter_never_hides_a_match(spark):
    rows = [(i, c[0]) for i, c in CASES.items()]
    # Letters that match ASCII letters when case is ignored.
    rows += [(i, t.replace("s", "\u017f").replace("i", "\u0130")) for i, t in rows if "i" in BY_ID[i].flags]
    rows += [(i, t.upper().replace("K", "K").replace("I", "ı")) for i, t in rows if "i" in BY_ID[i].flags]
    words = _words(default_rules())
    df = spark.createDataFrame(rows, "id string, text string").withColumn(_FOLDED, fold_case(F.col("text")))
    df = df.withColumns(_found_words(words))
    for r in default_rules():
        lost = df.where(F.col("text").rlike(r.java) & ~F.expr(_worth_trying(r, words)))
        assert lost.count() == 0, r.rule_id


def test_search_form_is_an_ending():
    for r in default_rules():
        for words in r.needs:
            for w in words:
                assert w.endswith(_search_form(w)) and len(_search_form(w)) >= min(4, len(w))


def test_dialect(spark):
    assert java_pattern(r"[^[\s]a\s", "i") == r"(?dUi)[^\[\s\x1c-\x1f]a[\s\x1c-\x1f]"
    assert java_pattern("['\"]\\'") == r"(?dU)[\x27\x22]\x27"
    cases = [
        (r"a(.*)", "", "a1\r2"), (r"(\s+)", "", "x \x1c y"), (r"(\w+)", "", "ünï_9"),
        (r"(x)$", "", "x\n"), (r"(É+)", "i", "éÉ"), (r"[&&](b)", "", "&b"), (r"(?P<n>a+)b", "", "aab"),
        (r"([]x]+)", "", "a]x"), (r"(?P<q>a)(?P=q)", "", "baac"), (r"(a{,2})b", "", "aaab"), (r"(?P<my_name>a)", "", "xa"),
    ]
    for pattern, flags, text in cases:
        want = re.findall(pattern, text, re.I if flags else 0)
        df = spark.createDataFrame([(text,)], "t string")
        got = df.select(F.regexp_extract_all("t", F.lit(java_pattern(pattern, flags)), F.lit(1))).first()[0]
        assert got == want, pattern


@pytest.mark.parametrize(
    "rule",
    [
        Rule("a b", "error_type", "strict", "x"), Rule("A", "nope", "strict", "x"),
        Rule("A", "error_type", "firm", "x"), Rule("A", "error_type", "strict", "x", base=1.5),
        Rule("A", "error_type", "strict", "(", "i"), Rule("A", "error_type", "strict", "x", "q"),
        Rule("A", "error_type", "strict", "x", needs=(("it's",),)),
        Rule("A", "error_type", "strict", "(a)(?(1)b|c)"),  # Python takes it, the JVM does not
    ],
)
def test_bad_rules_fail_when_the_plan_is_built(spark, rule):
    with pytest.raises(ValueError):
        check_rules([rule])


def test_duplicate_rule_ids_are_rejected():
    r = Rule("A", "error_type", "strict", "x")
    with pytest.raises(ValueError):
        check_rules([r, r])


def test_needs_in_any_case(spark):
    rule = Rule("A", "error_type", "strict", "(ERROR)", needs=(("ERROR",),))
    df = spark.createDataFrame([("an ERROR",)], "text string")
    assert bs.extract_field(df, "error_type", [rule]).first()["error_type"]["value"] == "ERROR"
