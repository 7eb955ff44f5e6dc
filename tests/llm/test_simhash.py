import random
import re

import numpy as np
import pytest
import xxhash

from bugsieve.llm import simhash
from bugsieve.llm.components import component_labels


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    """fps: list of (id, fingerprint); the smallest id that each row reaches."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(fps):
        root = find(i)
        if name is not None:
            least[root] = min(name, least.get(root, name))
    return [least.get(find(i)) for i in range(len(fps))]


def documents(small, spark):
    rng = random.Random(5)
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    rows = list(enumerate(texts))
    for i in range(120):  # near copies around one text
        words = texts[3].split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(["The", "of", "zz"])
        rows.append((1_000 + i, " ".join(words)))
    rows += [(2_000, None), (2_001, ""), (2_002, " \t\n"), (2_003, "One two"), (2_004, "one TWO"), (None, "one two"),
             (None, texts[3]), (5, texts[5]), (5, texts[5]), (3_000, "É é  É"), (3_001, "w " * 30_000)]
    return rows


@pytest.mark.parametrize("cell_rows", [simhash.CELL_ROWS, 1])
def test_against_brute_force(spark, small, cell_rows):
    rows = documents(small, spark)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fp string, component_id string")
    got = simhash.simhash_components(docs, cell_rows=cell_rows).collect()
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps), strict=True)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def test_dense_clusters_and_chains(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(400):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    at = rng.getrandbits(64)
    for step in range(60):  # a chain of links
        fps.add(at)
        at ^= 7 << (step % 60)
    fps |= {rng.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1, 2**63, 1}
    fps = sorted(fps)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    want = brute_components(list(enumerate(fps)))
    for cell_rows in (simhash.CELL_ROWS, 3):
        labels = {r.u: r.v for r in component_labels(simhash.links(frame, cell_rows=cell_rows)).collect()}
        groups = {}
        for i, f in enumerate(fps):
            signed = f - (1 << 64) if f >> 63 else f
            groups.setdefault(labels.get(signed, signed), []).append(i)
        assert sorted(groups.values()) == sorted(
            [i for i, c in enumerate(want) if c == root] for root in set(want)
        )


def test_embedding_bounds_the_distance(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-(2**63), 2**63, 500)
    b = a ^ (1 << rng.integers(0, 63, 500))
    frame = spark.createDataFrame(list(zip(a.tolist(), b.tolist(), strict=True)), "a long, b long")
    for r in frame.select("a", "b", simhash.embedding(frame.a).alias("x"), simhash.embedding(frame.b).alias("y")).collect():
        def counts(v):
            return [((v >> (2 * i)) & 3).bit_count() for i in range(32)]
        manhattan = sum(abs(p - q) for p, q in zip(counts(r.a), counts(r.b), strict=True))
        assert ((r.x ^ r.y) & (2**64 - 1)).bit_count() == manhattan <= ((r.a ^ r.b) & (2**64 - 1)).bit_count()


def test_empty_and_one_of_each(spark, small):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).collect() == []
    rows = documents(small, spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.one_of_each_component(docs)
    assert kept.columns == docs.columns
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    want = {i for (i, _), c in zip(fps, brute_components(fps), strict=True) if i == c and i is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want)
    assert got.count(None) == 2
