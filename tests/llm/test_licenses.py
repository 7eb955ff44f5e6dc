import random

from bugsieve.llm import licenses


def brute(text, templates, times, k=5, similarity=0.8):
    """Templates with that share of shingles in some window of so many times their words, at any start."""
    words, out = licenses.words_of(text), set()
    for name, template in templates.items():
        t = licenses.words_of(template)
        n = min(k, len(t))
        want = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}
        span = times * len(t)
        for start in range(max(1, len(words) - span + 1)):
            part = words[start : start + span]
            if len(want & {tuple(part[i : i + n]) for i in range(len(part) - n + 1)}) >= similarity * len(want):
                out.add(name)
                break
    return out


def test_places_and_changes(spark):
    rng = random.Random(6)
    rows, least, most = [], {}, {}
    for i in range(200):
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 300))]
        for name in rng.sample(sorted(licenses.TEMPLATES), rng.randint(0, 2)):
            notice = licenses.TEMPLATES[name].split()
            if len(notice) > 20 and rng.random() < 0.5:
                notice[rng.choice([0, -1])] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if rng.random() < 0.1 else w for w in notice]
        text = " ".join(words)
        rows.append((i, text, "x"))
        least[i] = brute(text, licenses.TEMPLATES, 1)
        most[i] = brute(text, licenses.TEMPLATES, 3)
    rows += [(None, "Released under the MIT License.", "x"), (900, None, "x"), (901, "", "x"), (902, "MIT license " * 50_000, "x")]
    rows += [(903, "all rights reserved", "y")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    got = {}
    for r in licenses.scan_licenses(docs).collect():
        assert 0.8 <= r.containment <= 1
        got.setdefault(r.doc_id, []).append(r.license)
    assert sorted(got.pop(903)) == ["all-rights-reserved"] * 2
    assert got.pop(None) == ["mit"]
    assert set(got) <= set(range(200))
    for i in range(200):
        assert least[i] <= set(got.get(i, [])) <= most[i]


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License")], "doc_id long, text string")
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert licenses.scan_licenses(docs, {"none": "..."}).count() == 0
    assert licenses.scan_licenses(docs, {}).count() == 0
