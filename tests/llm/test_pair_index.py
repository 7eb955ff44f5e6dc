import hashlib
import json
import random
import time

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bugsieve.llm import pair_index, queries

JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def codec():
    return pair_index.Codec(JSON)


def ids_of(data):
    return [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]


ODD = [
    "", "a", "a" * 1_001, "abab" * 300, "<|endoftext|>x<|endoftext|><|endoftext|>  y", " <|endoftext|> 's", "<|endoftext", " \n\n  x　\u0085  y",
    "日本語テキスト" * 50, "\u0000\x07 é́", "don't 've'LL 12³ ½", " " * 5_000 + "x", "\U0001f600\U0001f468‍\U0001f469 ok",
]


def test_against_the_library(codec, library):
    for text, ids in zip(ODD, codec.encode(ODD), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(ids) == want
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids_of(ids) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50_256), max_size=30))
def test_any_ids(codec, library, ids):
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_words_take_little_time(codec, library):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    before = time.time()
    (ids,) = codec.encode([text])
    assert time.time() - before < 10
    assert ids_of(ids) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bounds", [dict(TEXT_CHARS=40, TEXT_WORDS=3), dict(TEXT_CHARS=10_000_000, TEXT_WORDS=10)])
def test_lots_of_any_size(monkeypatch, library, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(pair_index, name, value)
    small = pair_index.Codec(JSON, memo_words=5, index_bytes=30)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["one", "twofold", "três", "<|endoftext|>", "x" * 300, "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    for text, ids in zip(texts, small.encode(texts), strict=True):
        assert ids_of(ids) == library.encode(text, add_special_tokens=False).ids
        assert len(small.memo) <= 20  # a lot at most, however many came before


def test_merges_out_of_order_are_refused(tmp_path):
    spec = json.load(open(JSON, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="in order"):
        pair_index.Codec(str(path))


def test_frames(spark):
    rows = [(i, t, "a", 1) for i, t in enumerate(ODD)] + [(-1, None, None, 2), (None, "no id", "b", 3), (0, "again", "c", 4), (0, "again", "c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, given_ int").repartition(3)
    out = pair_index.decode(pair_index.encode(docs, JSON), JSON)
    assert out.columns == ["doc_id", "text", "given_", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.decoded == (r.text or "") for r in got)
    assert [r.ids for r in got if r.text is None or r.text == ""] == [[], []]
    both = pair_index.round_trip(docs, JSON).collect()
    assert sorted(map(str, both)) == sorted(map(str, got))
    lists = spark.createDataFrame([(None,), ([],), ([99_999_999, 5, None],)], "ids array<int>")
    assert [r.decoded for r in pair_index.decode(lists, JSON).collect()] == ["", "", "&"]
    empty = spark.createDataFrame([], docs.schema)
    assert pair_index.round_trip(empty, JSON).collect() == []


def test_query(spark, small, library):
    got = {r.doc_id: r for r in queries.op12_pair_index_bpe(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id][1:] == (len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
