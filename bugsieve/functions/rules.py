"""The extraction rules: the built-in table, its access functions and rule validation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bugsieve.functions.dialect import java_pattern
from bugsieve.schema import FIELDS

TIERS = ("strict", "loose")
REGISTRY_VERSION = "2.0.0"

# Pattern text, flags (i ignore case, m multiline, s dot-all) and base
# confidence of every rule. Order within a tier decides ties. Any change here changes results.
_FIXED = {
    ("error_type", "strict"): [
        ("ET-S01", 1.00, "i", r"\[\d{4}-\d{2}-\d{2}T[^\]]+\]\s+(?:ERROR|CRITICAL)\s+\[[^\]]+\]\s+(.+?)(?:\n|$)"),
        ("ET-S02", 0.93, "m", r"^\[[^\]]+?\][:\s-]+([A-Z][^:\n]{20,}?)(?:\s+after|\s+when|\s+on|\s+in|\s+through|\n)"),
        ("ET-S03", 0.92, "i", r"(Screen\s+Reader[^\]:\n]*(?:issue|error|reading|announcing)[^.\n]{0,50})"),
        ("ET-S04", 0.90, "i", r"((?:JAWS|NVDA|VoiceOver)\s+(?:is\s+)?(?:reading|announcing|not\s+announcing)[^.\n]+)"),
        ("ET-S05", 0.90, "i", r"(Accessibility\s+(?:issue|violation|error|problem)[^.\n]*)"),
        ("ET-S06", 0.92, "i", r"((?:Application|Program)\s+fails?\s+to\s+(?:launch|start|open)[^.\n]*)"),
        ("ET-S07", 0.95, "i", r"\b(NullPointerException|NPE)\b"),
        ("ET-S08", 0.95, "i", r"\b(IndexOutOfBoundsException)\b"),
        ("ET-S09", 0.95, "i", r"\b(SQLException)\b"),
        ("ET-S10", 0.95, "i", r"\b(TimeoutException)\b"),
        ("ET-S11", 0.95, "i", r"\b(ConnectionRefusedException)\b"),
        ("ET-S12", 0.95, "i", r"\b(FileNotFoundException)\b"),
        ("ET-S13", 0.95, "i", r"\b(OutOfMemoryError|Out of memory)\b"),
        ("ET-S14", 0.95, "i", r"\b(StackOverflowError)\b"),
        ("ET-S15", 0.95, "i", r"\b(5\d{2})\s+(?:Gateway\s+)?(?:Timeout|Error|Internal Server Error)\b"),
        ("ET-S16", 0.90, "i", r"\b(4\d{2})\s+(?:Not Found|Unauthorized|Forbidden|Bad Request)\b"),
        ("ET-S17", 0.95, "i", r"(Connection\s+pool\s+exhausted)"),
        ("ET-S18", 0.95, "i", r"(Connection\s+timeout)"),
        ("ET-S19", 0.95, "i", r"(Circuit\s+breaker\s+triggered)"),
        ("ET-S20", 0.95, "i", r"(Service\s+(?:dependency\s+)?(?:unavailable|unresponsive))"),
        ("ET-S21", 0.95, "i", r"(Memory\s+usage\s+critical)"),
        ("ET-S22", 0.95, "i", r"(Memory\s+leak\s+detected)"),
        ("ET-S23", 0.95, "i", r"(Cascade\s+failure)"),
        ("ET-S24", 0.95, "i", r"(Database\s+connection\s+(?:error|failed|timeout))"),
        ("ET-S25", 0.95, "i", r"(endpoint\s+timeouts?\s+detected)"),
        ("ET-S26", 0.90, "i", r"(Request\s+processing\s+failed)"),
        ("ET-S27", 0.90, "i", r"(health\s+(?:status\s+)?(?:degraded|changed\s+to\s+DEGRADED))"),
        ("ET-S28", 0.90, "i", r"(queue\s+overflow)"),
    ],
    ("error_type", "loose"): [
        ("ET-L01", 0.70, "i", r"ERROR\s+\[[^\]]+\]\s+([^:\n]+)"),
        ("ET-L02", 0.65, "i", r"(error\s+rate\s+exceeded\s+threshold[^.]*)"),
        ("ET-L03", 0.60, "i", r"(failed\s+to\s+[^.:\n]+)"),
        ("ET-L04", 0.60, "i", r"(unable\s+to\s+[^.:\n]+)"),
        ("ET-L05", 0.55, "i", r"\b(timeout|timed?\s*out)\b"),
        ("ET-L06", 0.50, "i", r"\b(failure|failed|crash(?:ed)?)\b"),
        ("ET-L07", 0.50, "i", r"\b(degraded|unavailable|unresponsive)\b"),
    ],
    ("component_module", "strict"): [
        ("CM-S01", 0.93, "im", r"^\[([^\]]+?(?:Service\s+Now|ServiceNow)[^\]]*?)\]"),
        ("CM-S02", 0.88, "m", r"^\[([A-Za-z][^\]\-:]{2,40}?)\s*-"),
        ("CM-S03", 0.90, "i", r"(?:Application|Product|System|Tool)[:\s]+([A-Z][A-Za-z0-9\s]{3,30}?)(?:\s+(?:Version|Build|RS\d)|\s*[\n,])"),
        ("CM-S04", 0.87, "i", r"Screen\s+Readers?[:\s-]+([A-Za-z0-9][A-Za-z0-9\s.]{3,40}?)(?:\s*[-:]|\n)"),
        ("CM-S05", 0.85, "i", r"(?:URL|Website|Portal)[:\s]+https?://([a-z0-9.-]+)"),
        ("CM-S06", 0.95, "i", r"ERROR\s+\[([a-zA-Z][\w-]*(?:-[a-zA-Z][\w-]*)*)\]"),
        ("CM-S07", 0.95, "i", r"CRITICAL\s+\[([a-zA-Z][\w-]*(?:-[a-zA-Z][\w-]*)*)\]"),
        ("CM-S08", 0.90, "i", r"WARN\s+\[([a-zA-Z][\w-]*(?:-[a-zA-Z][\w-]*)*)\]"),
        ("CM-S09", 0.92, "i", r"(?:unavailable|unresponsive)[:\s]+([a-zA-Z][\w-]*-service)"),
        ("CM-S10", 0.92, "i", r"([a-zA-Z][\w-]*-service)\s+(?:unavailable|unresponsive|status)"),
        ("CM-S11", 0.90, "i", r"services?\s+degraded[:\s]+([a-zA-Z][\w-]*(?:-[a-zA-Z][\w-]*)*)"),
        ("CM-S12", 0.90, "i", r"in\s+module\s+[\"']?([A-Za-z0-9_.]+)[\"']?"),
        ("CM-S13", 0.88, "i", r"at\s+([A-Za-z0-9_.]+)\.([A-Za-z0-9_]+)\("),
        ("CM-S14", 0.90, "i", r"in\s+(?:the\s+)?([A-Z][A-Za-z]+(?:Service|Module|Controller|Manager|Handler))"),
        ("CM-S15", 0.90, "i", r"component[:\s]+[\"']?([A-Za-z0-9_.-]+)[\"']?"),
    ],
    ("component_module", "loose"): [
        ("CM-L01", 0.70, "i", r"\b([a-z]+-[a-z]+(?:-[a-z]+)*-?service)\b"),
        ("CM-L02", 0.65, "i", r"\b([a-z]+-[a-z]+(?:-[a-z]+)*)\b(?=\s+(?:status|unavailable|degraded|error))"),
        ("CM-L03", 0.65, "", r"\b([A-Z][A-Za-z]*Service)\b"),
        ("CM-L04", 0.65, "", r"\b([A-Z][A-Za-z]*Controller)\b"),
        ("CM-L05", 0.60, "", r"\b([A-Z][A-Za-z]*Manager)\b"),
        ("CM-L06", 0.60, "", r"\b([A-Z][A-Za-z]*Handler)\b"),
        ("CM-L07", 0.70, "i", r"(?:backend|upstream)\s+service[:\s]+([a-zA-Z][\w-]+)"),
    ],
    ("trigger_repro_steps", "strict"): [
        ("RS-S01", 0.95, "is", r"(?:steps?\s+to\s+reproduce|reproduction\s+steps?|repro\s+steps?)[:\s]+(.*?)(?:\n\n|expected|actual|$)"),
        ("RS-S02", 0.90, "is", r"(?:how\s+to\s+reproduce|to\s+reproduce)[:\s]+(.*?)(?:\n\n|expected|actual|$)"),
        ("RS-S03", 0.85, "is", r"(?:repro)[:\s]+(.*?)(?:\n\n|expected|$)"),
        ("RS-S04", 0.85, "m", r"((?:^|\n)\s*1[\.\)]\s+.+(?:\n\s*\d[\.\)]\s+.+)+)"),
    ],
    ("trigger_repro_steps", "loose"): [
        ("RS-L01", 0.55, "i", r"(?:when\s+(?:I|user|you|clicking|accessing))\s+([^.\n]+)"),
        ("RS-L02", 0.50, "i", r"(?:(?:click|navigate|go\s+to|open|access|visit)(?:ing|ed)?)\s+([^.\n]+)"),
        ("RS-L03", 0.45, "i", r"(?:if\s+you)[:\s]+([^.\n]+)"),
        ("RS-L04", 0.60, "i", r"((?:\[\d{4}-[^\]]+\]\s+(?:ERROR|WARN|INFO)[^\n]+\n?){2,})"),
    ],
    ("observed_behavior", "strict"): [
        ("OB-S01", 0.95, "is", r"(?:actual\s+(?:behavior|result)|what\s+happened|observed(?:\s+behavior)?|current\s+behavior)[:\s]+(.*?)(?:\n\n|expected|$)"),
        ("OB-S02", 0.85, "is", r"(?:result|outcome)[:\s]+(.*?)(?:\n\n|$)"),
        ("OB-S03", 0.90, "i", r"((?:customer|user)\s+impact[:\s]+[^\n]+)"),
        ("OB-S04", 0.90, "i", r"(\d+\s+users?\s+affected[^\n]*)"),
    ],
    ("observed_behavior", "loose"): [
        ("OB-L01", 0.65, "i", r"(?:ERROR|CRITICAL)[^\]]*\]\s+([^:\n]+(?:failed|error|timeout|unavailable)[^.\n]*)"),
        ("OB-L02", 0.55, "i", r"(?:but|instead|however)[:\s]+([^.\n]+)"),
        ("OB-L03", 0.50, "i", r"(?:shows?|displays?|returns?|gives?)[:\s]+([^.\n]+)"),
        ("OB-L04", 0.60, "i", r"(application\s+crash(?:es|ed)?[^.\n]*)"),
        ("OB-L05", 0.60, "i", r"(service\s+(?:is\s+)?(?:down|unavailable|unresponsive)[^.\n]*)"),
    ],
    ("expected_behavior", "strict"): [
        ("EX-S01", 0.95, "is", r"(?:expected\s+(?:behavior|result|outcome)|should\s+(?:be|have|work))[:\s]+(.*?)(?:\n\n|$)"),
        ("EX-S02", 0.90, "is", r"(?:acceptance\s+criteria|expected)[:\s]+(.*?)(?:\n\n|$)"),
    ],
    ("expected_behavior", "loose"): [
        ("EX-L01", 0.60, "i", r"(?:should|must|needs?\s+to)\s+((?:be|have|show|display|work|complete|return|process)[^.\n]+)"),
        ("EX-L02", 0.50, "i", r"(?:want|need|expect(?:ing)?)[:\s]+([^.\n]+)"),
        ("EX-L03", 0.55, "i", r"(?:normally|correctly|properly|successfully)[,\s]+([^.\n]+)"),
        ("EX-L04", 0.55, "i", r"(?:threshold|SLA|limit)[:\s]+(\d+[^.\n]*)"),
    ],
}

# Same language and same captures as the fixed pattern of that id, written so that the JVM
# matcher neither recurses once per line or name part (a long run would overflow the task's
# stack and take the executor down) nor backtracks exponentially or quadratically.
# tests/test_rules.py checks each one against its fixed pattern on generated text.
_LOG_LINE = r"\[\d{4}-[^\]]++\]\s++(?:ERROR|WARN|INFO)[^\n]"
# [a-z] and [a-z-] as the JVM takes them where case is ignored, written out: a set is looked up, while
# case is folded anew at every place of the text.
_LETTERS = r"a-zA-Z\u0130\u0131\u017f\u212a"
_LETTER, _LETTER_OR_DASH = rf"(?-i:[{_LETTERS}])", rf"(?-i:[{_LETTERS}-])"
_LETTER_RUN = rf"(?-i:[{_LETTERS}]++)"
_RUN_START = rf"(?={_LETTER})(?<!{_LETTER})(?<!{_LETTER}-)(?:\b|{_LETTER_RUN}-)"
_STACK_SAFE = {
    "CM-S06": r"ERROR\s+\[([a-zA-Z][\w-]*+)\]",
    "CM-S07": r"CRITICAL\s+\[([a-zA-Z][\w-]*+)\]",
    "CM-S08": r"WARN\s+\[([a-zA-Z][\w-]*+)\]",
    "CM-S10": r"(?:\G|(?<![\w-]))(?:(?![a-zA-Z])[\w-])*+([a-zA-Z][\w-]*-service)\s+(?:unavailable|unresponsive|status)",
    "CM-S11": r"services?\s+degraded[:\s]+([a-zA-Z][\w-]*+)",
    # A run of names joined by single hyphens is entered at its first name only (at the second
    # if the first does not begin a word): where that fails, all later names fail alike.
    "CM-L01": rf"{_RUN_START}({_LETTER_RUN}-{_LETTER}(?:{_LETTER_OR_DASH}(?<!--))*service)\b",
    "CM-L02": rf"{_RUN_START}({_LETTER_RUN}-{_LETTER}(?:{_LETTER_OR_DASH}(?<!--))*+)\b(?=\s+(?:status|unavailable|degraded|error))",
    "RS-S04": r"((?:^|\n)\s*1[\.\)]\s+.++(?:\n\s*\d[\.\)]\s+.++)++)",
    # Of all keywords before the same bracket only the first is tried: the others fail alike.
    "OB-L01": r"(?:\G|(?<=\]))(?>[^\]]*?(?:ERROR|CRITICAL))[^\]]*+\]\s+([^:\n]+(?:failed|error|timeout|unavailable)[^.\n]*)",
    # A run of whole lines, or one line that holds a second stamped entry.
    "RS-L04": rf"((?:{_LOG_LINE}++\n?+){{2,}}+|{_LOG_LINE}+(?:{_LOG_LINE}++\n?+)++)",
}

# As above, for time alone: white space is entered once, not once for each word that may follow.
_QUICKER = {
    "ET-S02": r"^\[[^\]]+?\][:\s-]+([A-Z][^:\n]{20,}?)(?:\s+(?:after|when|on|in|through)|\n)",
}

# Words a text must contain, in lower case, before a rule can match: any line of
# alternatives, all words of the line. A rule without an entry is always tried.
_NEEDS = {
    "ET-S01": [("error", "["), ("critical", "[")],
    "ET-S02": [("[", "]")],
    "ET-S03": [("screen", "reader")],
    "ET-S04": [("jaws",), ("nvda",), ("voiceover",)],
    "ET-S05": [("accessibility",)],
    "ET-S06": [("application", "fail"), ("program", "fail")],
    "ET-S07": [("exception", "nullpointerexception"), ("npe",)],
    "ET-S08": [("exception", "indexoutofboundsexception")],
    "ET-S09": [("exception", "sqlexception")],
    "ET-S10": [("exception", "timeoutexception")],
    "ET-S11": [("exception", "connectionrefusedexception")],
    "ET-S12": [("exception", "filenotfoundexception")],
    "ET-S13": [("memory", "outofmemoryerror"), ("memory", "out of memory")],
    "ET-S14": [("error", "stackoverflowerror")],
    "ET-S15": [("5", "timeout"), ("5", "error")],
    "ET-S16": [("4", "not found"), ("4", "unauthorized"), ("4", "forbidden"), ("4", "bad request")],
    "ET-S17": [("connection", "exhausted")],
    "ET-S18": [("connection", "timeout")],
    "ET-S19": [("circuit", "breaker")],
    "ET-S20": [("unavailable", "service"), ("unresponsive", "service")],
    "ET-S21": [("memory", "usage")],
    "ET-S22": [("memory", "leak")],
    "ET-S23": [("cascade", "failure")],
    "ET-S24": [("connection", "database")],
    "ET-S25": [("timeout", "endpoint")],
    "ET-S26": [("request", "processing")],
    "ET-S27": [("degraded", "health")],
    "ET-S28": [("queue", "overflow")],
    "ET-L01": [("error", "[")],
    "ET-L02": [("error", "exceeded")],
    "ET-L03": [("failed",)],
    "ET-L04": [("unable",)],
    "ET-L05": [("time", "out")],
    "ET-L06": [("failure",), ("failed",), ("crash",)],
    "ET-L07": [("degraded",), ("unavailable",), ("unresponsive",)],
    "CM-S01": [("[", "service", "now")],
    "CM-S02": [("[", "-")],
    "CM-S03": [("application",), ("product",), ("system",), ("tool",)],
    "CM-S04": [("screen", "reader")],
    "CM-S05": [("http", "url"), ("http", "website"), ("http", "portal")],
    "CM-S06": [("error", "[")],
    "CM-S07": [("critical", "[")],
    "CM-S08": [("warn", "[")],
    "CM-S09": [("unavailable", "-service"), ("unresponsive", "-service")],
    "CM-S10": [("unavailable", "-service"), ("unresponsive", "-service"), ("status", "-service")],
    "CM-S11": [("degraded", "service")],
    "CM-S12": [("module",)],
    "CM-S13": [("(", ".", "at")],
    "CM-S14": [("service",), ("module",), ("controller",), ("manager",), ("handler",)],
    "CM-S15": [("component",)],
    "CM-L01": [("-", "service")],
    "CM-L02": [("-", "status"), ("-", "unavailable"), ("-", "degraded"), ("-", "error")],
    "CM-L03": [("service",)],
    "CM-L04": [("controller",)],
    "CM-L05": [("manager",)],
    "CM-L06": [("handler",)],
    "CM-L07": [("service", "backend"), ("service", "upstream")],
    "RS-S01": [("repro", "step")],
    "RS-S02": [("repro", "reproduce")],
    "RS-S03": [("repro",)],
    "RS-S04": [("1.",), ("1)",)],
    "RS-L01": [("when",)],
    "RS-L02": [("click",), ("navigate",), ("go",), ("open",), ("access",), ("visit",)],
    "RS-L03": [("if", "you")],
    "RS-L04": [("[", "error"), ("[", "warn"), ("[", "info")],
    "OB-S01": [("actual",), ("happened",), ("observed",), ("current",)],
    "OB-S02": [("result",), ("outcome",)],
    "OB-S03": [("impact",)],
    "OB-S04": [("affected",)],
    "OB-L01": [("error", "]"), ("critical", "]", "failed"), ("critical", "]", "timeout"), ("critical", "]", "unavailable")],
    "OB-L02": [("but",), ("instead",), ("however",)],
    "OB-L03": [("show",), ("display",), ("return",), ("give",)],
    "OB-L04": [("application", "crash")],
    "OB-L05": [("service", "down"), ("unavailable", "service"), ("unresponsive", "service")],
    "EX-S01": [("expected",), ("should",)],
    "EX-S02": [("expected",), ("acceptance",)],
    "EX-L01": [("should",), ("must",), ("need",)],
    "EX-L02": [("want",), ("need",), ("expect",)],
    "EX-L03": [("normally",), ("correctly",), ("properly",), ("successfully",)],
    "EX-L04": [("threshold",), ("sla",), ("limit",)],
}


@dataclass(frozen=True)
class Rule:
    """One extraction rule.

    ``pattern`` is in Python ``re`` syntax. ``engine_pattern`` is an optional equivalent that
    the JVM matcher runs instead. ``needs`` is an optional prefilter (see ``_NEEDS``); the case
    of its words does not matter.
    """

    rule_id: str
    field: str
    tier: str
    pattern: str
    flags: str = "i"
    base: float = 0.5
    needs: tuple[tuple[str, ...], ...] = ()
    engine_pattern: str | None = None

    @property
    def groups(self) -> int:
        return re.compile(self.pattern).groups

    @property
    def java(self) -> str:
        return java_pattern(self.engine_pattern or self.pattern, self.flags)


def default_rules() -> list[Rule]:
    """The built-in rule set, in tie-break order."""
    return [
        Rule(
            rule_id, field, tier, pattern, flags, base,
            tuple(_NEEDS.get(rule_id, ())), {**_STACK_SAFE, **_QUICKER}.get(rule_id),
        )
        for (field, tier), rows in _FIXED.items()
        for rule_id, base, flags, pattern in rows
    ]


def _runs(patterns: Sequence[str]) -> bool:
    """Whether the JVM takes all the patterns; one row and no data are read."""
    tried = ", ".join(f"regexp_extract_all('', r'{p}', 0)" for p in patterns)
    try:
        SparkSession.active().sql(f"SELECT {tried}").collect()
    except PySparkException:
        return False
    return True


def check_rules(rules: Sequence[Rule]) -> list[Rule]:
    """Reject unusable rules while the plan is built, not inside a task."""
    seen = set()
    for r in rules:
        if r.rule_id in seen:
            raise ValueError(f"duplicate rule id {r.rule_id!r}")
        seen.add(r.rule_id)
        if not re.fullmatch(r"[A-Za-z0-9_-]+", r.rule_id):
            raise ValueError(f"rule id {r.rule_id!r} may hold letters, digits, _ and - only")
        if r.field not in FIELDS:
            raise ValueError(f"rule {r.rule_id}: unknown field {r.field!r}")
        if r.tier not in TIERS:
            raise ValueError(f"rule {r.rule_id}: unknown tier {r.tier!r}")
        if not 0.0 <= r.base <= 1.0:
            raise ValueError(f"rule {r.rule_id}: base confidence {r.base} is outside [0, 1]")
        if set(r.flags) - set("ims"):
            raise ValueError(f"rule {r.rule_id}: unknown flags {r.flags!r}")
        if any(not w or set(w) & set("'\"\\") for words in r.needs for w in words):
            raise ValueError(f"rule {r.rule_id}: prefilter words may not hold quotes or backslashes")
        try:
            re.compile(r.pattern)
        except re.error as e:
            raise ValueError(f"rule {r.rule_id}: {e}") from e
    if rules and not _runs([r.java for r in rules]):
        bad = [r.rule_id for r in rules if not _runs([r.java])]
        raise ValueError(f"rules {bad}: Spark's matcher does not take their patterns")
    return list(rules)


def rules_df(spark: SparkSession, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rule table as a DataFrame."""
    rules = default_rules() if rules is None else check_rules(rules)
    position: dict[tuple[str, str], int] = {}
    rows = []
    for r in rules:
        ordinal = position.get((r.field, r.tier), 0)
        position[(r.field, r.tier)] = ordinal + 1
        rows.append((r.rule_id, r.field, r.tier, ordinal, r.pattern, r.flags, float(r.base)))
    return spark.createDataFrame(
        rows,
        "rule_id string, field string, tier string, ordinal int, pattern string, flags string, base double",
    )


def registry_counts(spark: SparkSession, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Number of rules per field and tier."""
    return (
        rules_df(spark, rules)
        .groupBy("field")
        .pivot("tier", list(TIERS))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(TIERS))
    )
