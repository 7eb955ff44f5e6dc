import base64
import random
import struct
import time

import public_tokenizers as P
import pytest
import tiktoken

from bugsieve.llm import bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS, P.PATTERN)


def ids(data):
    return [x for (x,) in struct.iter_unpack("<I", data)]


def strange_texts():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéßñç"
    return [
        "", " ", "\n\n \t ", "a" * 3_000, " " * 700 + "x", "ab" * 900, "=" * 1_111, "<|endoftext|> is text",
        "".join(rng.choice(letters) for _ in range(2_500)),
        "".join(rng.choice("ab") for _ in range(1_500)),
        " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)),
        "漢字かな交じり文 🤖🤖 é  ​ I'll we've 12345678901234567890",
        "".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x4E00, 0x9FFF)])) for _ in range(800)),
    ]


def test_equals_the_library(codec, library):
    texts = strange_texts()
    got = codec.encode(texts)
    assert [ids(x) for x in got] == [library.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]


def test_bounds_change_nothing(library, monkeypatch):
    texts = strange_texts()
    for name, value in (("TEXT_CHARS", 50), ("WORD_BYTES", 20), ("ROUNDS", 3), ("DECODE_TOKENS", 7)):
        monkeypatch.setattr(bpe, name, value)
    small = bpe.Codec(RANKS, P.PATTERN, memo_words=30)
    got = small.encode(texts)
    assert [ids(x) for x in got] == [library.encode_ordinary(t) for t in texts]
    assert small.decode(got) == [t.encode() for t in texts]


def test_frames(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(None, None, "x"), (-1, "", None), (-1, "", None)], docs.schema)
    docs = docs.unionByName(extra).withColumnRenamed("lang", "ids")
    rows = bpe.bpe_round_trip(docs, RANKS, P.PATTERN).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert ids(r.ids) == library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded).decode() == texts[r.doc_id]
    some = docs.where("doc_id < 20")
    coded = bpe.bpe_encode(some, RANKS, P.PATTERN)
    back = bpe.bpe_decode(coded, RANKS, P.PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in back} == {i: texts[i] for i in texts if i is not None and i < 20}
    assert bpe.bpe_round_trip(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_long_words_take_little_time(library):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rng.choice(some) for _ in range(100_000)) for some in (letters, letters + letters.upper() + "0123456789+/")]
    texts.append("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(30_000)))
    fresh = bpe.Codec(RANKS, P.PATTERN)
    for text in texts:
        before = time.time()
        got = fresh.encode([text])
        assert time.time() - before < 10
        assert ids(got[0]) == library.encode_ordinary(text) and fresh.decode(got) == [text.encode()]


def test_parts_join_to_the_word(codec):
    for text in strange_texts():
        data = text.encode()
        parts = codec.parts_of(data)
        assert b"".join(parts) == data
        assert not any(a[-1:] + b[:1] in piece for a, b in zip(parts, parts[1:], strict=False) for piece in list(codec.ranks)[::50])
