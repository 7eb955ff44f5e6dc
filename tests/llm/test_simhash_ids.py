import itertools
import random

from bugsieve.llm import simhash
from tests.llm.test_passages import prose


def test_an_id_on_two_texts(spark):
    rng = random.Random(3)
    a, b, c = (prose(rng, 60) for _ in range(3))
    for rows in itertools.permutations([(1, b), (5, a), (5, b)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        kept = sorted((r.doc_id, r.text) for r in simhash.one_of_each_component(docs).collect())
        assert kept == sorted([(1, b), (5, a)])
    rows = [(5, a, 1), (5, b, 2), (5, b, 3), (7, c, 4), (7, c, 4), (9, c, 5), (None, c, 6), (None, c, 6), (8, None, 7), (8, "", 8)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, id_ int").repartition(3)
    out = simhash.one_of_each_component(docs)
    assert out.columns == docs.columns
    kept = [tuple(r) for r in out.collect()]
    assert sorted((i, t or "") for i, t, _ in kept if i is not None) == sorted([(5, a), (5, b), (7, c), (8, "")])
    assert [r for r in kept if r[0] is None] == [(None, c, 6)] * 2
    again = [tuple(r) for r in simhash.one_of_each_component(docs.repartition(5)).collect()]
    assert sorted(map(str, again)) == sorted(map(str, kept))
