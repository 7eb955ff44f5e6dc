"""Quality rules: decision lists learned by sequential covering from labelled statistics."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bugsieve.llm.common import appended, columns_of, free_names

#: Labelled rows that a list is learned from at most: those whose ids have the smallest hashes.
TRAIN_ROWS = 20_000
#: Share of a rule's training rows that must be rejects, and the rejects it must cover.
MIN_PRECISION, MIN_COVER = 0.95, 5
MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 12, 4, 48

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper_words", "n_distinct_words", "n_marks", "n_digits",
)
#: Statistics that rules test: quotients of two counts.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "digits_per_char": ("n_digits", "word_chars"),
    "chars_per_word": ("word_chars", "n_words"),
}

_SYMBOLS = "#*$%&|<>"
_MARK = re.compile(r"[^\w\s]")
_DIGIT = re.compile(r"[0-9]")


def repeated_words(words: list, width: int = 3) -> int:
    """Words in windows that occur twice or more in the list, each word once."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    keys = ids[:n]
    for i in range(1, width):
        _, keys = np.unique(keys, return_inverse=True)
        keys = keys.astype(np.int64) * len(number) + ids[i : i + n]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(width):
        covered[i : i + n] |= again
    return int(covered.sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of a text; words are runs without ASCII white space, null has none."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r"),
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(w.isupper() for w in text.split()),
        len(set(words)),
        len(_MARK.findall(text)),
        len(_DIGIT.findall(text)),
    )


def _count_columns(texts: pa.Array) -> list[pa.Array]:
    found = [counts_of(x.as_py()) for x in texts]
    columns = zip(*found, strict=True) if found else [[]] * len(COUNTS)
    return [pa.array(x, type=pa.int64()) for x in columns]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the ``COUNTS``) of each row's whole text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return appended(rows, ["text"], [T.StructField(c, T.LongType()) for c in COUNTS], _count_columns).drop("text")


def ratio(name: str, prefix: str = "") -> Column:
    above, below = RATIOS[name]
    return F.col(prefix + above).cast("double") / F.greatest(F.col(prefix + below), F.lit(1)).cast("double")


@dataclass(frozen=True)
class Rule:
    """Rejects where all conditions (statistic, '>' or '<=', threshold) hold."""

    conditions: tuple[tuple[str, str, float], ...]

    def column(self, prefix: str = "") -> Column:
        out = F.lit(True)
        for name, sign, value in self.conditions:
            out = out & (ratio(name, prefix) > value if sign == ">" else ratio(name, prefix) <= value)
        return out

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), dtype=bool)
        for name, sign, value in self.conditions:
            out &= table[name] > value if sign == ">" else table[name] <= value
        return out


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition of most information gain until no good row is covered."""
    conditions: list[tuple[str, str, float]] = []
    live = np.ones(len(bad), dtype=bool)
    while len(conditions) < MAX_CONDITIONS and (live & ~bad).any():
        p, n = (live & bad).sum(), (live & ~bad).sum()
        before = np.log2(p / (p + n))
        best = (0.0, None, None)
        for name, values in table.items():
            cuts = np.unique(np.quantile(values[live], np.linspace(0, 1, THRESHOLDS)))
            for value in (cuts[:-1] + cuts[1:]) / 2:
                above = live & (values > value)
                for sign, now in ((">", above), ("<=", live & ~above)):
                    a, b = (now & bad).sum(), (now & ~bad).sum()
                    if a:
                        gain = a * (np.log2(a / (a + b)) - before)
                        if gain > best[0]:
                            best = (gain, (name, sign, float(value)), now)
        if best[1] is None:
            break
        conditions.append(best[1])
        live = best[2]
    return Rule(tuple(conditions))


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drop last conditions while that does not harm (rejects - others) / covered on held-out rows."""

    def worth(r: Rule) -> float:
        now = r.holds(table)
        return (2 * (now & bad).sum() - now.sum()) / max(1, now.sum())

    best, value = rule, worth(rule)
    for n in range(len(rule.conditions) - 1, 0, -1):
        shorter = Rule(rule.conditions[:n])
        if (w := worth(shorter)) >= value:
            best, value = shorter, w
    return best


def learn(table: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """An ordered list of rejecting rules: each is grown on two thirds of the rows not yet
    covered, pruned on the rest, and taken while it is precise enough on both."""
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    third = rng.integers(0, 3, len(bad)) == 0
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES and (left & bad).sum() >= MIN_COVER:
        parts = [({k: v[left & m] for k, v in table.items()}, bad[left & m]) for m in (~third, third)]
        if not parts[0][1].any():
            break
        rule = _grow(*parts[0])
        if len(parts[1][1]):
            rule = _prune(rule, *parts[1])
        covered = rule.holds(table) & left
        hits = (covered & bad).sum()
        if not rule.conditions or hits < MIN_COVER or hits < MIN_PRECISION * covered.sum():
            break
        rules.append(rule)
        left &= ~covered
    return rules


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The list as one conditional expression: the first rule that holds rejects."""
    out = None
    for rule in rules:
        holds = rule.column(prefix)
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < 50) | (100 * repeated > 50 * words)


def learn_rules(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> list[Rule]:
    """Rules from at most ``train_rows`` labelled documents, less those that fail the base checks."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("id"), "id").limit(train_rows)
    )
    sample = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(known), "id")
    counted = appended(sample, ["text"], [T.StructField(c, T.LongType()) for c in COUNTS], _count_columns)
    rows = (
        counted.where(~base_failed()).select("quality", *[ratio(r).alias(r) for r in RATIOS]).limit(train_rows).toPandas()
    )
    if not len(rows):
        return []
    rows = rows.sort_values(list(rows.columns)).reset_index(drop=True)  # the order of rows is chance
    return learn({r: rows[r].to_numpy() for r in RATIOS}, rows["quality"].to_numpy() == 0)


def quality_rules(
    docs: DataFrame, labels: DataFrame, training: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, the first five ``COUNTS``, base_failed, kept, rejected_by, further statistics).

    ``kept`` is false for texts with fewer than 50 words or mostly repeated ones, and where a
    rule learned from ``labels`` (doc_id, quality) and the documents ``training`` (by default
    ``docs``) rejects; ``rejected_by`` is the number of that rule. Rules are learned from a
    bounded sample; statistics and verdicts cover every row. Without usable labels there are no
    rules. A null text has no words; repeated rows stay; an empty table gives no rows.
    """
    rules = learn_rules(docs if training is None else training, labels)
    number = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        number = F.when(rule.column(), F.lit(i)).otherwise(number)
    return statistics(docs, id_col, text_col).select(
        F.col("id").alias(id_col), *COUNTS[:5], base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
        F.when(~base_failed(), number).alias("rejected_by"), *COUNTS[5:],
    )


def keep_by_rules(
    docs: DataFrame, labels: DataFrame, training: DataFrame | None = None, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with their columns, that ``quality_rules`` keeps; nothing is shuffled."""
    rules = learn_rules(docs if training is None else training, labels)
    fields = [T.StructField(c, T.LongType()) for c in COUNTS]

    def work(texts: pa.Array) -> list[pa.Array]:
        return [pa.StructArray.from_arrays(_count_columns(texts), names=list(COUNTS))]

    (counts,) = free_names(docs, "counts_")
    counted = appended(docs, [text_col], [T.StructField(counts, T.StructType(fields))], work)
    kept = counted.where(~base_failed(counts + ".") & verdict(rules, counts + "."))
    return kept.select(*columns_of(docs))
