import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bugsieve.llm import packing

JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 40), st.integers(1, 9_000)), max_size=60))
def test_plan_holds_every_token_once(lengths):
    seen = [np.zeros(n, dtype=int) for n in lengths]
    partial = 0
    for tier, pieces in packing.plan(lengths):
        size = sum(n for *_, n in pieces)
        assert size == tier <= 2048 and tier & (tier - 1) == 0
        partial += tier < 256
        for doc, start, n in pieces:
            seen[doc][start : start + n] += 1
    assert all((x == 1).all() for x in seen)
    assert partial <= 8


@pytest.mark.parametrize("lot", [packing.LOT_TOKENS, 3_000])
def test_against_the_library(spark, small, library, lot):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(-1, None, "x"), (-2, "", None), (-3, "a<|endoftext|> b  c\n\n", "y"), (-4, "é" * 30_000, "z"), (None, "no id", "q")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumnRenamed("lang", "offset").repartition(3, "doc_id")
    rows = packing.pack(docs, JSON, lot_tokens=lot, with_ids=True).toPandas()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows["key"] = [-99 if np.isnan(x) else int(x) for x in rows.doc_id]
    texts[-99] = texts.pop(None)
    assert set(rows.key) == set(texts)
    for key, pieces in rows.groupby("key"):
        want = np.array(library.encode(texts[key], add_special_tokens=False).ids + [1], dtype="<u4")
        at = 0
        for r in pieces.sort_values("start").itertuples():
            part = want[at : at + r.length].tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, r.ids) == (at, len(want), zlib.crc32(part), part)
            at += r.length
        assert at == len(want)
    for _, pieces in rows.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces.offset.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]]
        assert pieces.length.sum() == pieces.tier.iloc[0] <= 2048
    steps = rows.groupby("step_group").agg(tokens=("length", "sum"), tiers=("tier", "nunique"))
    assert steps.tokens.max() <= packing.STEP_TOKENS and steps.tiers.max() == 1


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same")], "doc_id long, text string")
    assert packing.pack(docs, JSON).count() >= 2
    assert packing.pack(docs.limit(0), JSON).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([2048, 1024, 512, 256, 64, 1]), st.integers(1, 4_000_000)), max_size=200), st.sampled_from([2048, 5_000, 32_768]))
def test_step_groups_are_balanced(sequences, step):
    tiers, costs = [t for t, _ in sequences], [c for _, c in sequences]
    groups = {}
    for (tier, cost), group in zip(sequences, packing.step_groups(tiers, costs, step), strict=True):
        groups.setdefault(group, []).append((tier, cost))
    assert sorted(groups) == list(range(len(groups)))
    for tier in set(tiers):
        mine = [[c for _, c in g] for g in groups.values() if g[0][0] == tier]
        assert all({t for t, _ in g} == {tier} for g in groups.values() if g[0][0] == tier)
        sizes = [len(g) for g in mine]
        assert max(sizes) * tier <= max(step, tier) and max(sizes) - min(sizes) <= 1
        assert len(mine) == -(-sum(sizes) // max(1, step // tier))
        all_ = [c for g in mine for c in g]
        for size in set(sizes):
            sums = [sum(g) for g in mine if len(g) == size]
            assert max(sums) - min(sums) <= max(all_) - min(all_)
