"""Repeated passages against all repeated word runs of small tables."""

import random

import pytest

from bugsieve.llm import passages
from tests.llm.test_passages import prose


def repeated_runs(rows, size):
    """Whether each word of each text lies in a run of ``size`` words that a text with a smaller id has too."""
    first = {}
    for doc, text in rows:
        words = text.split()
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            first[key] = min(first.get(key, doc), doc)
    inside = {}
    for doc, text in rows:
        words = text.split()
        mark = [False] * len(words)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < doc:
                mark[i : i + size] = [True] * size
        inside[doc] = mark
    return inside


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_word_runs(spark, seed):
    rng = random.Random(seed)
    pool = [prose(rng, rng.randint(20, 120)) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [prose(rng, rng.randint(5, 60)) for _ in range(3)]
        parts += rng.sample(pool, rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((i, (" " if seed % 2 else "\n").join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 120, 9)]
    must = repeated_runs(rows, 51)  # words that are in a long repeated run
    may = repeated_runs(rows, 6)  # no word outside of these goes
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in passages.remove_repeated_passages(docs).collect()}
    missed = total = 0
    for doc, text in rows:
        at, gone = 0, []
        spans = [(s.start, s.end) for s in got[doc].removed_spans]
        for word in text.split():
            at = text.index(word, at)
            gone.append(any(a <= at and at + len(word) <= b for a, b in spans))
            cut = any(a < at + len(word) and at < b for a, b in spans)
            assert cut == gone[-1], "words stay whole"
            at += len(word)
        assert all(m for g, m in zip(gone, may[doc], strict=True) if g)
        total += sum(must[doc])
        missed += sum(m and not g for g, m in zip(gone, must[doc], strict=True))
    assert total > 5_000 and missed <= 0.001 * total, (missed, total)


def test_steps_are_made_once_and_other_texts_stay_out(spark):
    rng = random.Random(9)
    shared = prose(rng, 80)
    rows = [(i, prose(rng, 60) + (f"\n{shared}" if i % 50 == 0 else "")) for i in range(400)]
    out = passages.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # the cut itself; every step before it is a table
    assert sum(r.removed_chars > 0 for r in out.collect()) == 7
