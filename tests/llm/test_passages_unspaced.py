import random

import pytest

from bugsieve.llm import passages
from tests.llm.test_passages import prose


def unspaced(rng, kind, size):
    if kind == "run":
        return "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(size))
    first, last = {"chinese": (0x4E00, 0x9FA5), "japanese": (0x3041, 0x3096), "thai": (0x0E01, 0x0E2E)}[kind]
    return "".join(chr(rng.randint(first, last)) for _ in range(size))


@pytest.mark.parametrize("kind", ["run", "chinese", "japanese", "thai"])
def test_texts_without_white_space(spark, kind):
    rng = random.Random(13)
    whole, passage = unspaced(rng, kind, 900), unspaced(rng, kind, 1_200)
    rows = [
        (1, whole), (2, whole),  # exact copies
        (3, unspaced(rng, kind, 300) + passage + unspaced(rng, kind, 300)),
        (4, unspaced(rng, kind, 500) + passage + unspaced(rng, kind, 200)),
        (5, unspaced(rng, kind, 900)),
    ]
    got = {r.doc_id: r for r in passages.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    before = dict(rows)
    assert got[2].text == "" and got[2].kept_in == [1]
    assert all(got[i].text == before[i] for i in (1, 3, 5))
    assert len(passage) - 50 - 2 * passages.RUN_BYTES <= got[4].removed_chars <= len(passage) and got[4].kept_in == [3]


def test_words_in():
    assert passages.words_in(b"a few  plain words") == 4
    assert passages.words_in(prose(random.Random(1), 40).encode()) == 40
    assert passages.words_in(b"x" * 180) == 30 and passages.words_in(b"x" * 32) == 1
