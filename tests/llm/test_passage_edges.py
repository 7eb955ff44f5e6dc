import random

from bugsieve.llm import passages
from tests.llm.test_passages import prose


def test_passages_inside_a_line_are_always_found(spark):
    rng = random.Random(11)
    rows, planted = [], {}
    for i in range(600):
        shared = prose(rng, 51)
        for doc in (2 * i, 2 * i + 1):
            rows.append((doc, f"{prose(rng, 40)} {shared} {prose(rng, 40)}"))
        planted[2 * i + 1] = shared
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = dict(rows)
    got = {r.doc_id: r for r in passages.remove_repeated_passages(docs).collect()}
    for doc, shared in planted.items():
        assert got[doc - 1].text == before[doc - 1]
        at = before[doc].index(shared)
        (span,) = got[doc].removed_spans
        assert span.start == at and before[doc][at : span.end].rstrip() == shared, doc
        assert got[doc].kept_in == [doc - 1]


def test_short_repeats_stay(spark):
    rng = random.Random(12)
    rows = []
    for i in range(60):
        shared = prose(rng, 28)
        rows += [(2 * i + k, f"{prose(rng, 40)} {shared} {prose(rng, 40)}") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in passages.remove_repeated_passages(docs).collect()} == dict(rows)
