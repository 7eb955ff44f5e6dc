"""Rule extraction: best rule per field and text, as one narrow (shuffle-free) projection.

Every (rule, number of matches) pair has a confidence that is known while the plan is built.
Sorting these pairs gives each a rank, so the best rule of a text is the hit with the greatest
rank, and confidence, score, source and rule id are lookups by rank.

Expressions over many rules are written as SQL text: one parsed expression per stage instead
of ten thousand calls between Python and the JVM while the plan is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.functions.rules import TIERS, Rule, check_rules, default_rules
from bugsieve.functions.scoring import SHORT_LENGTH, boosted, occurrence_boost, scored
from bugsieve.functions.text import (
    WHITESPACE,
    fold_case,
    shorten_evidence,
    truncate_value,
    window_at,
)
from bugsieve.schema import FIELDS

_FOLDED = "__folded"
_FOUND = "__found"
_BITS = 62
_SOURCE = {"strict": "regex_strict", "loose": "regex_loose"}
# The repeat bonus is at its maximum from the third match on.
_COUNTED_MATCHES = (1, 2, 3)
_HITS = "array<struct<position:int,value:string,matches:int>>"
_BEST = "struct<rank:int,value:string>"
RESULT = (
    "struct<value:string,confidence:double,source:string,raw_evidence:string,"
    "raw_confidence:double,rule_id:string>"
)
# English letters from rare to common; a prefilter word is searched by its rarest start.
_RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate"
_MIN_WORD = 4
# Strict rules per step; after each step, rules that can no longer win are left out.
_SEGMENT = 8


def _search_form(word: str) -> str:
    """An ending of ``word`` that starts with a rare letter.

    A byte search compares on from every place where the first byte fits, so a rare first byte
    makes it several times faster. A text that holds the word holds its ending.
    """
    if not (word.isascii() and word.isalpha() and word.islower()):
        return word
    starts = range(max(1, len(word) - _MIN_WORD + 1))
    return word[min(starts, key=lambda i: _RARE_FIRST.find(word[i])) :]


def _words(rules: Sequence[Rule]) -> list[str]:
    """The distinct words that the prefilters of the rules search for."""
    return list(dict.fromkeys(_search_form(w.lower()) for r in rules for ws in r.needs for w in ws))


def _found_words(words: Sequence[str]) -> dict[str, Column]:
    """Which of the words the folded text holds, as bits of long columns; each is searched once.

    Bits keep the generated code of many conditions within the JVM's method size limit.
    """
    parts = [words[i : i + _BITS] for i in range(0, len(words), _BITS)]
    return {
        f"{_FOUND}_{j}": F.expr(
            " | ".join(f"if(contains({_FOLDED}, '{w}'), {1 << i}L, 0L)" for i, w in enumerate(part))
        )
        for j, part in enumerate(parts)
    }


def _worth_trying(rule: Rule, words: Sequence[str]) -> str:
    """SQL for the prefilter of a rule, by the words found; true for a rule without one."""
    place = {w: i for i, w in enumerate(words)}
    options = []
    for needed in rule.needs:
        masks: dict[int, int] = {}
        for i in sorted({place[_search_form(w.lower())] for w in needed}):
            masks[i // _BITS] = masks.get(i // _BITS, 0) | 1 << (i % _BITS)
        options.append(" AND ".join(f"{_FOUND}_{j} & {m}L = {m}L" for j, m in masks.items()))
    return " OR ".join(f"({o})" for o in options) or "true"


def _all_values(rule: Rule, text: str) -> str:
    """SQL for the value of every match: the group, or the non-empty groups joined by a space."""

    def group(g: int) -> str:
        return f"regexp_extract_all({text}, r'{rule.java}', {g})"

    if rule.groups < 2:
        return group(rule.groups)
    numbers = range(1, rule.groups + 1)
    arrays = ", ".join(f"{group(g)}" for g in numbers)
    parts = ", ".join(f"nullif(m.`{g - 1}`, '')" for g in numbers)
    return f"transform(arrays_zip({arrays}), m -> concat_ws(' ', {parts}))"


def _hits(rules: Sequence[Rule], text: str, worth: Callable[[Rule], str]) -> str:
    """SQL for the rules that match a text: an array of (position in ``rules``, value, matches).

    ``worth`` gives the prefilter of a rule. A rule whose first value is empty is left out even
    when a later value is not. The matches of a rule are dropped as soon as they are counted,
    so a large text holds those of one rule at a time.

    ``transform`` and ``filter`` are evaluated outside whole-stage code generation, and that is
    wanted here: the generated method for a few dozen patterns exceeds the JVM's size limits,
    so it would not be compiled to machine code, while nearly all the time goes to the matcher.
    """
    if not rules:
        return f"CAST(NULL AS {_HITS})"
    tried = ", ".join(
        f"CASE WHEN {worth(r)} THEN get(transform(array({_all_values(r, text)}), v -> "
        f"named_struct('position', {i}, 'value', btrim(get(v, 0), r'{WHITESPACE}'), "
        "'matches', size(v))), 0) END"
        for i, r in enumerate(rules)
    )
    return f"filter(array({tried}), h -> coalesce(h.value != '', false))"


@dataclass(frozen=True)
class _Cell:
    """One outcome: this rule won with this many matches."""

    rule: Rule
    matches: int
    confidence: float


class _FieldPlan:
    """The rules of one field and the ranking of their outcomes."""

    def __init__(self, field: str, rules: Sequence[Rule]):
        self.field = field
        self.tiers = {t: [r for r in rules if r.field == field and r.tier == t] for t in TIERS}
        self.rules = self.tiers["strict"] + self.tiers["loose"]
        self.cells: list[_Cell] = []
        # Any strict outcome outranks any loose one; within a tier the higher confidence
        # wins and the earlier rule wins ties.
        for tier in ("loose", "strict"):
            ranked = [
                (boosted(r.base, n), -i, n, r)
                for i, r in enumerate(self.tiers[tier])
                for n in _COUNTED_MATCHES
            ]
            ranked.sort(key=lambda c: c[:3])
            self.cells += [_Cell(r, n, conf) for conf, _, n, r in ranked if conf > 0.0]
        self.rank = {(c.rule.rule_id, c.matches): k for k, c in enumerate(self.cells, 1)}
        self.segments = self._segments()

    def _segments(self) -> list[list[Rule]]:
        """The strict rules in steps: up to the first of top confidence, then a few at a time."""
        strict = self.tiers["strict"]
        top = [k for k, r in enumerate(strict, 1) if boosted(r.base, 1) >= 1.0]
        cuts = [*range(top[0] if top else 0, len(strict), _SEGMENT)]
        parts = [strict[: cuts[0]] if cuts else strict, *(strict[c : c + _SEGMENT] for c in cuts)]
        return [p for p in parts if p]

    def worth(self, rule: Rule) -> str:
        return f"get(__worth_{self.field}, {self.rules.index(rule)})"

    def best(self, rules: Sequence[Rule], text: str, worth: Callable[[Rule], str]) -> str:
        """SQL for the winner among ``rules``: (rank, value), NULL when none hits."""
        if not rules:
            return f"CAST(NULL AS {_BEST})"
        ranks = ", ".join(
            "array({})".format(
                ", ".join(
                    str(self.rank.get((r.rule_id, n), "CAST(NULL AS INT)")) for n in _COUNTED_MATCHES
                )
            )
            for r in rules
        )
        rank = f"get(get(array({ranks}), h.position), least(h.matches, {_COUNTED_MATCHES[-1]}) - 1)"
        outcome = (
            f"CASE WHEN {rank} IS NOT NULL THEN "
            f"named_struct('rank', {rank}, 'value', h.value) END"
        )
        return f"array_max(transform({_hits(rules, text, worth)}, h -> {outcome}))"

    def strict(self, step: int, text: str) -> str:
        """SQL for the best strict outcome after one more segment.

        A segment is skipped where the winner so far outranks all it could bring.
        """
        segment = self.segments[step] if step < len(self.segments) else []
        best = self.best(segment, text, self.worth)
        if step == 0:
            return best
        so_far = f"__strict_{self.field}"
        reachable = max(self.rank.get((r.rule_id, n), 0) for r in segment for n in _COUNTED_MATCHES)
        return (
            f"array_max(array({so_far}, CASE WHEN coalesce({so_far}.rank < {reachable}, true) "
            f"THEN {best} END))"
        )

    def strict_or_loose(self, text: str) -> str:
        strict = f"__strict_{self.field}"
        loose = self.best(self.tiers["loose"], text, self.worth)
        return f"CASE WHEN {strict} IS NULL THEN {loose} ELSE {strict} END"

    def lookup(self, per_cell: Callable[[_Cell], str]) -> Column:
        values = ", ".join(per_cell(c) for c in self.cells)
        return F.expr(f"get(array({values}), __best_{self.field}.rank - 1)")

    def result(self) -> Column:
        """The winning outcome as a struct, NULL when no rule hits."""
        if not self.cells:
            return F.lit(None).cast(RESULT)

        def final(length: int) -> Callable[[_Cell], str]:
            return lambda c: f"{scored(c.confidence, _SOURCE[c.rule.tier], True, length)!r}D"

        best = F.col(f"__best_{self.field}")
        return F.when(
            best.isNotNull(),
            F.struct(
                truncate_value(best["value"]).alias("value"),
                F.when(F.col(f"__length_{self.field}") < SHORT_LENGTH, self.lookup(final(1)))
                .otherwise(self.lookup(final(SHORT_LENGTH)))
                .alias("confidence"),
                self.lookup(lambda c: f"'{_SOURCE[c.rule.tier]}'").alias("source"),
                shorten_evidence(F.col(f"__evidence_{self.field}")).alias("raw_evidence"),
                self.lookup(lambda c: f"{c.confidence!r}D").alias("raw_confidence"),
                self.lookup(lambda c: f"'{c.rule.rule_id}'").alias("rule_id"),
            ),
        )


def extract_fields(
    df: DataFrame,
    fields: Sequence[str] = FIELDS,
    rules: Sequence[Rule] | None = None,
    text_col: str = "text",
) -> DataFrame:
    """Add one struct column per field: value, confidence, source, raw_evidence, raw_confidence, rule_id.

    Only the rules of the named fields are tried, so name the fields you need. Loose rules run
    only where the strict tier found nothing.

    The result passes a generator (``inline`` of one row). Without it a filter on a result
    would be pushed below the extraction, where it repeats the patterns of every column it
    refers to. Filters on the other columns still reach the scan.
    """
    if not fields:
        raise ValueError("name at least one field")
    unknown = set(fields) - set(FIELDS)
    if unknown:
        raise ValueError(f"unknown fields {sorted(unknown)}; known are {list(FIELDS)}")
    rules = default_rules() if rules is None else check_rules(rules)
    plans = [_FieldPlan(f, rules) for f in fields]
    text = F.col(text_col)
    quoted = f"`{text_col}`"
    carried = df.columns

    # One projection per step, so that no step is computed again by the one that uses it twice.
    def stage(df: DataFrame, name: str, column: Callable[[_FieldPlan], Column]) -> DataFrame:
        return df.withColumns({f"__{name}_{p.field}": column(p) for p in plans})

    words = _words([r for p in plans for r in p.rules])
    out = df.withColumn(_FOLDED, fold_case(text)).withColumns(_found_words(words))
    out = stage(
        out, "worth",
        lambda p: F.expr(f"array({', '.join(_worth_trying(r, words) for r in p.rules)})"),
    )
    out = stage(out, "strict", lambda p: F.expr(p.strict(0, quoted)))
    for step in range(1, max(len(p.segments) for p in plans)):
        out = out.withColumns(
            {
                f"__strict_{p.field}": F.expr(p.strict(step, quoted))
                for p in plans
                if step < len(p.segments)
            }
        )
    out = stage(out, "best", lambda p: F.expr(p.strict_or_loose(quoted)))
    places = {}
    for p in plans:
        value = F.col(f"__best_{p.field}")["value"]
        places[f"__at_{p.field}"] = F.instr(text, value)
        places[f"__length_{p.field}"] = F.length(value)
    out = out.withColumns(places)
    out = stage(
        out,
        "evidence",
        lambda p: window_at(
            text,
            F.col(f"__best_{p.field}")["value"],
            F.col(f"__at_{p.field}"),
            F.col(f"__length_{p.field}"),
        ),
    )
    results = F.struct(*[p.result().alias(p.field) for p in plans])
    return out.select(
        *[F.col(f"`{c}`") for c in carried if c not in fields], F.inline(F.array(results))
    )


def extract_field(
    df: DataFrame, field: str, rules: Sequence[Rule] | None = None, text_col: str = "text"
) -> DataFrame:
    """``extract_fields`` for one field."""
    return extract_fields(df, [field], rules, text_col)


def extract_all_fields(
    df: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text"
) -> DataFrame:
    """``extract_fields`` for the five core fields."""
    return extract_fields(df, FIELDS, rules, text_col)


def rule_hits(
    df: DataFrame,
    field: str | None = None,
    rules: Sequence[Rule] | None = None,
    text_col: str = "text",
) -> DataFrame:
    """One row per text and rule that hits: value, number of matches, confidence.

    Every rule is tried, the loose tier too. The text itself is not carried into the rows.
    """
    rules = default_rules() if rules is None else check_rules(rules)
    rules = [r for r in rules if field is None or r.field == field]
    carried = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    ordinals, seen = [], {}
    for r in rules:
        ordinals.append(seen.get((r.field, r.tier), 0))
        seen[(r.field, r.tier)] = ordinals[-1] + 1

    def of_rule(values: list[str]) -> Column:
        return F.expr(f"get(array({', '.join(values)}), __hit.position)")

    matches = F.col("__hit.matches")
    words = _words(rules)
    hits = F.expr(_hits(rules, f"`{text_col}`", lambda r: _worth_trying(r, words)))
    return (
        df.withColumn(_FOLDED, fold_case(F.col(text_col))).withColumns(_found_words(words))
        .select(*carried, F.explode(hits).alias("__hit"))
        .select(
            *carried,
            of_rule([f"'{r.rule_id}'" for r in rules]).alias("rule_id"),
            of_rule([f"'{r.field}'" for r in rules]).alias("field"),
            of_rule([f"'{r.tier}'" for r in rules]).alias("tier"),
            of_rule([str(n) for n in ordinals]).alias("ordinal"),
            F.col("__hit.value").alias("value"),
            matches.alias("matches"),
            occurrence_boost(of_rule([f"{float(r.base)!r}D" for r in rules]), matches).alias(
                "confidence"
            ),
        )
    )


def best_in_tier(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best rule per text, field and tier from ``rule_hits`` rows.

    For callers that keep hits in a table; ``extract_fields`` needs no grouping.
    """
    best = F.max(
        F.struct("confidence", (-F.col("ordinal")).alias("order"), "rule_id", "value", "matches")
    )
    return (
        hits.groupBy(*keys, "field", "tier")
        .agg(best.alias("b"))
        .select(*keys, "field", "tier", "b.rule_id", "b.value", "b.matches", "b.confidence")
    )
