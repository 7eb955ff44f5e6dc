import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from bugsieve.llm import divergence, queries
from checks import compare

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, ranks=50):
    """The audit of (text, lang, source) rows, term by term."""
    counts, totals, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        totals[lang].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def p(own, kept=kept, v=v):
            n = sum(own[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (own[t] + 5) // (n + 5 * v) for t in kept}

        mine, all_ = p(counts[lang, source]), p(totals[lang])
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                theirs = p(counts[lang, other])
                pairs.append((other, sum(abs(mine[t] - theirs[t]) for t in kept)))
        terms = [(t, mine[t] - all_[t]) for t in kept if counts[lang, source][t] and mine[t] > all_[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def rows_of(frame):
    assert frame.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in frame.collect())


def table(rng, n, sources=7):
    words = ["the", "The", "naïve", "Ünit", "ÄRGER", "日本語", "x", "a1b2", "don't"] + [
        "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 3))) for _ in range(150)
    ]
    rows = []
    for _ in range(n):
        source = "hot" if rng.random() < 0.5 else f"s{rng.randrange(sources)}"
        text = " ".join(rng.choice(words[: rng.choice([20, 60, 159])]) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice([text, text, text + "\x00\x7f\n" + text.upper(), None]), rng.choice(["en", "de", "", None]), rng.choice([source, source, None])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = table(rng, 900)
    rows += [(None, "en", "silent"), ("", "xx", "only"), (None, "yy", "a"), (None, "yy", "b")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert rows_of(divergence.audit_sources(docs)) == brute(rows)


def test_bounds_change_nothing(spark, monkeypatch):
    rng = random.Random(3)
    rows = table(rng, 400, sources=12)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, no int, term string")
    want = brute(rows, least=5, ranks=3)
    assert rows_of(divergence.audit_sources(docs, min_documents=5, term_ranks=3)) == want
    for name, value in (("BLOCK", 3), ("CELLS", 100), ("LOT_TERMS", 16), ("HELD", 10), ("BITS", 7)):
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.audit_sources(docs, min_documents=5, term_ranks=3)) == want


def test_no_rows_and_no_terms(spark):
    schema = "text string, lang string, source string"
    assert divergence.audit_sources(spark.createDataFrame([], schema)).collect() == []
    rows = [("few words", "en", "a"), ("few words", "en", "b"), ("more", "en", "c")]
    assert rows_of(divergence.audit_sources(spark.createDataFrame(rows, schema))) == brute(rows)


def test_very_long_text(spark):
    rows = [("word " * 300_000, "en", "long")] + [("word other", "en", "b")] * 40
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert rows_of(divergence.audit_sources(docs)) == brute(rows)


def test_query_against_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    df = queries.op13_source_divergence(spark, small)
    cur = con.execute(queries.ORACLES["op13_source_divergence"])
    assert compare.rows_of(df.collect(), df.columns) == compare.rows_of(cur.fetchall(), [d[0] for d in cur.description])
