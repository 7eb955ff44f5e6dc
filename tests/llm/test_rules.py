import collections
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bugsieve.llm import rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab#| é \n\t\r\x0b\x0c\x1c ", max_size=60))
def test_counts(text):
    assert rules.counts_of(text)[:5] == brute(text)


def test_learned_list_separates():
    rng = np.random.default_rng(1)
    n = 3_000
    table = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    bad = (table["a"] > 0.9) | ((table["b"] <= 0.2) & (table["c"] > 0.7))
    found = rules.learn(table, bad)
    said = np.zeros(n, dtype=bool)
    for rule in found:
        said |= rule.holds(table)
    assert (said & bad).sum() > 0.95 * bad.sum() and (said & ~bad).sum() < 0.01 * n
    assert rules.learn(table, np.zeros(n, dtype=bool)) == []
    assert rules.learn({k: v[:4] for k, v in table.items()}, np.array([True, False, True, False])) == []


def test_frames(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    extra = [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "word " * 100, "en", "s", 500), (0, "again", "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).selectExpr("*", "1 AS n_words", "2 AS kept", "3 AS _x")
    rows = rules.quality_rules(docs, labels).collect()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(brute(r.text))
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in texts[r.doc_id]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.rejected_by is None)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(quality[r.doc_id], r.kept) for r in rows if r.doc_id in quality and not r.base_failed]
    assert sum(q == k for q, k in judged) >= 0.98 * len(judged)
    assert all(k for q, k in judged if q == 1)
    kept = rules.keep_by_rules(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train, test = labels.where("pmod(hash(doc_id), 2) = 0"), labels.where("pmod(hash(doc_id), 2) = 1")
    judged = rules.quality_rules(docs, train).where("NOT base_failed").join(test, "doc_id").collect()
    assert sum((r.quality == 1) == r.kept for r in judged) >= 0.97 * len(judged)


def test_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b c " * 5 + " ".join(map(str, range(80))), "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in ([], [(1, None)], [(1, 1)], [(7, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert [r.kept for r in rules.quality_rules(docs, labels).collect()] == [True]
    assert rules.quality_rules(docs.limit(0), labels).count() == 0
