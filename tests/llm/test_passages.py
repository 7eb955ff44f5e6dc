import random

import numpy as np
import pytest

from bugsieve.llm import passages


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(words))


def test_chunks_resist_shifts():
    rng = random.Random(2)
    text = prose(rng, 2_000)
    _, _, plain = passages.chunks_of(text.encode())
    _, _, shifted = passages.chunks_of(("new words " + text[:3_000] + "in the middle " + text[3_000:]).encode())
    assert len(set(plain.tolist()) - set(shifted.tolist())) < 40 < 0.2 * len(plain)


@pytest.mark.parametrize("size", [300, 5_000])
def test_pieces_make_the_same_chunks(monkeypatch, size):
    rng = random.Random(3)
    texts = [prose(rng, 3_000), "x" * 9_000, "漢字" * 4_000, (prose(rng, 40) + "\n") * 60, "", " " * 500, "a b " * 2_000]
    whole = [passages.chunks_of(t.encode()) for t in texts]
    monkeypatch.setattr(passages, "PIECE_BYTES", size)
    for text, want in zip(texts, whole, strict=True):
        got = passages.chunks_of(text.encode())
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
        data = text.encode()
        for start, end in zip(*got[:2], strict=True):
            assert passages.MIN_BYTES <= end - start <= passages.MAX_BYTES
            data[start:end].decode()


def test_texts_cut_together_have_their_own_chunks(monkeypatch):
    rng = random.Random(6)
    texts = []
    for _ in range(400):
        pieces = ["a", "b ", "word\n", "x" * rng.randrange(1, 200), "漢字" * rng.randrange(1, 40), " ", "\n", "\x00", prose(rng, 8)]
        texts.append("".join(rng.choice(pieces) for _ in range(rng.randrange(0, 60))).encode())
    texts.append(prose(rng, 40_000).encode())
    for size in (200_000, 3_000):
        monkeypatch.setattr(passages, "LOT_BYTES", size)
        for text, got in zip(texts, passages.chunks_of_many(texts), strict=True):
            assert all(np.array_equal(a, b) for a, b in zip(got, passages.chunks_of(text), strict=True))
    assert passages.chunks_of_many([]) == []


def test_equal_digests_are_equal_chunks():
    rng = random.Random(4)
    seen = {}
    for _ in range(30):
        data = prose(rng, 500).encode()
        for start, end, digest in zip(*passages.chunks_of(data), strict=True):
            assert seen.setdefault(digest, data[start:end]) == data[start:end]


def test_planted_passages(spark):
    rng = random.Random(5)
    shared = [prose(rng, rng.randint(51, 90)) for _ in range(6)]
    short = [prose(rng, 14) for _ in range(3)]
    rows, planted = [], {}
    for i in range(160):
        lines = [prose(rng, rng.randint(30, 80)) for _ in range(4)]
        if i % 3 == 0:
            lines.insert(rng.randint(0, 4), shared[i % 6])  # a line of its own
            planted[i] = i % 6
        elif i % 3 == 1 and i % 2:
            j = rng.randint(0, 3)
            lines[j] = lines[j][:60] + " " + shared[5] + " " + lines[j][60:]  # inside a line
            planted[i] = 5
        lines.append(short[i % 3])
        rows.append((i, "\n".join(lines)))
    rows += [(900, rows[10][1]), (901, rows[10][1]), (902, rows[10][1])]  # exact copies
    repeats = prose(rng, 60)
    rows += [(903, "\n".join([repeats] * 4)), (904, None), (905, ""), (None, rows[0][1]), (3, rows[3][1])]
    docs = spark.createDataFrame(
        [(i, t, 1, "k") for i, t in rows], "doc_id long, text string, owner int, spans_ string"
    )
    out = passages.remove_repeated_passages(docs)
    assert out.columns == [*docs.columns, "removed_chars", "removed_spans", "kept_in"]
    before, after = {}, {}
    for i, t in rows:
        before.setdefault(i, t)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        after.setdefault(r.doc_id, r)
    first = {}
    for i, s in sorted(planted.items()):
        first.setdefault(s, i)
    whole = 0
    for i, s in planted.items():
        if first[s] == i:
            assert shared[s] in after[i].text
        else:
            whole += shared[s] in after[i].text
            if i % 3 == 0:
                assert shared[s] not in after[i].text and first[s] in after[i].kept_in
    assert whole <= 1  # inside a line the edges depend on the neighbours, and a miss is rare
    for i in range(160):
        if i not in planted:
            assert after[i].text == before[i] and after[i].removed_chars == 0
    for i in (900, 901, 902):
        assert len(after[i].text) < 130 and 10 in after[i].kept_in
    assert after[903].text == before[903] and after[904].text is None and after[905].text == ""
    assert after[None].text == rows[0][1]
    for r in got:  # spans name what went
        if r.text is not None and r.doc_id is not None:
            at, parts = 0, []
            for s in r.removed_spans:
                parts.append(before[r.doc_id][at : s.start])
                at = s.end
            assert "".join(parts) + before[r.doc_id][at:] == r.text
            assert len(before[r.doc_id]) - len(r.text) == r.removed_chars


def test_empty_table(spark):
    assert passages.remove_repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
