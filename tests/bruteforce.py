"""Plain-Python model of extraction and scoring for small fixtures.

It runs the fixed patterns with ``re`` one text at a time and keeps every hit in a list, so it
shares nothing with the Spark plan but the rule table.
"""

import re

from bugsieve.functions.rules import default_rules
from bugsieve.schema import FIELDS

_FLAG = {"i": re.I, "m": re.M, "s": re.S}


def hits(text, rules=None):
    """(rule, value, matches, confidence) of every rule that matches with a value."""
    out = []
    for r in default_rules() if rules is None else rules:
        flags = 0
        for f in r.flags:
            flags |= _FLAG[f]
        found = list(re.compile(r.pattern, flags).finditer(text))
        if not found:
            continue
        groups = found[0].groups() or (found[0].group(),)
        value = " ".join(g for g in groups if g).strip()
        if value:
            n = len(found)
            out.append((r, value, n, min(1.0, r.base + min(0.2, 0.1 * (n - 1)))))
    return out


def field(text, name, rules=None):
    """value, raw confidence, source, evidence and rule id, or None."""
    for tier in ("strict", "loose"):
        mine = [h for h in hits(text, rules) if (h[0].field, h[0].tier) == (name, tier)]
        mine = [h for h in mine if h[3] > 0]
        if not mine:
            continue
        rule, value, _, confidence = max(mine, key=lambda h: h[3])  # max keeps the first of equals
        if value in text:
            begin = text.index(value)
            evidence = text[max(0, begin - 50) : begin + len(value) + 50]
        else:
            evidence = value[:200]
        evidence = evidence if len(evidence) <= 497 else evidence[:497] + "..."
        value = value if len(value) <= 1000 else value[:997] + "..."
        return value, confidence, f"regex_{tier}", evidence, rule.rule_id
    return None


def score(confidence, source, length, has_evidence=True):
    weight = {
        "regex_strict": 0.95, "regex_loose": 0.70, "rule_based": 0.85, "ado_api": 1.0,
        "user_provided": 0.60, "nlp_enriched": 0.50,
    }.get(source, 0.5)
    points = confidence * weight
    if has_evidence:
        points = min(1.0, points + 0.05)
    if 1 <= length <= 4:
        points = points * 0.8
    return round(points, 3)


def record(text, rules=None):
    """Per field (value, score, source, evidence), and the overall confidence."""
    out, scores = {}, []
    for name in FIELDS:
        found = field(text, name, rules)
        if found is None:
            out[name] = (None, 0.0, "regex_loose", None)
        else:
            value, confidence, source, evidence, _ = found
            out[name] = (value, score(confidence, source, len(value)), source, evidence)
            scores.append(out[name][1])
    overall = sum(scores) / len(scores) * (len(scores) / len(FIELDS)) if scores else 0.0
    return out, overall
