"""The scan against every window of every text."""

import random

import pytest

from bugsieve.llm import licenses


def every_window(text, scanner, templates, k=5, similarity=0.8):
    """The templates of which some window, of the size that the scan compares, holds the share, with
    the largest share of any."""
    words, out = licenses.words_of(text), {}
    sizes = {name: c.window for c in scanner.classes for name in c.names}
    for name, template in templates.items():
        t = licenses.words_of(template)
        n = min(k, len(t))
        want = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}
        places = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        span = sizes[name] - n + 1
        best = max((len(want.intersection(places[a : a + span])) for a in range(max(1, len(places) - span + 1))), default=0)
        if best >= similarity * len(want):
            out[name] = best / len(want)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_scan_equals_every_window(seed):
    rng = random.Random(seed)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    hits = 0
    for _ in range(120):
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 150))]
        for name in rng.sample(sorted(licenses.TEMPLATES), rng.randint(0, 3)):
            notice = licenses.TEMPLATES[name].split()
            for _ in range(rng.choice([0, 0, 1, 2, 3])):  # words put in, left out or changed
                at = rng.randrange(len(notice))
                notice[at : at + rng.randint(0, 1)] = ["other"] * rng.randint(0, rng.choice([1, 1, len(notice)]))
                notice = notice or ["none"]
            at = rng.randint(0, len(words))
            words[at:at] = notice
        text = " ".join(words)
        want = every_window(text, scanner, licenses.TEMPLATES)
        assert {name: share for name, share, _ in scanner.scan(text)} == want
        hits += len(want)
    assert hits > 40


def test_each_template_finds_itself_and_few_others():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    both = {"apache-2.0-header": {"apache-2.0"}, "mit-permission": set()}
    for name, text in licenses.TEMPLATES.items():
        found = {n: share for n, share, _ in scanner.scan(f"before it {text} and after")}
        assert found[name] == 1.0
        assert set(found) - {name} <= both.get(name, set()), (name, found)
