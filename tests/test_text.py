import unicodedata

import pytest
from pyspark.sql import functions as F

from bugsieve.functions import text as tx


@pytest.fixture
def run(spark):
    def apply(fn, *values):
        df = spark.createDataFrame([(v,) for v in values], "t string")
        return [r[0] for r in df.select(fn(F.col("t"))).collect()]

    return apply


def test_whitespace_is_complete():
    assert set(tx.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_clean_freetext(run):
    texts = [
        "", " \t\n ", "\x00 a", "a\x00b", "a\xa0b\u200bc\r\nd", "\u3000 a \x1c", "tab\there\n", "\x85x\u2028y\ufeffz",
        "emoji 😀 ok", "soft\xadhyphen", "é\u0301",
    ]
    want = ["".join(c for c in t.strip() if c.isprintable() or c in "\n\t") for t in texts]
    assert run(tx.clean_freetext, *texts) == want


def test_clean_freetext_for_every_assigned_character(spark):
    # Characters both engines know: assigned, and not newer than the JVM's Unicode tables.
    chars = [chr(i) for i in range(0x3000) if unicodedata.ucd_3_2_0.category(chr(i)) != "Cn"]
    df = spark.createDataFrame([(f"a{c}b",) for c in chars], "t string")
    got = [r[0] for r in df.select(tx.clean_freetext(F.col("t"))).collect()]
    assert got == [f"a{c}b" if c.isprintable() or c in "\n\t" else "ab" for c in chars]


def test_strip_html(run):
    got = run(
        tx.strip_html, "<p>a</p>", "a < b > c", "&nbsp;x&nbsp;y&nbsp;", "&amp;lt;", "&lt;b&gt;", "<a\nb>c", "x <> y",
        "&amp;nbsp;",
    )
    assert got == ["a", "a  c", "x y", "&amp;lt;".replace("&lt;", "<"), "<b>", "c", "x <> y", "&amp;nbsp;"]


def test_sanitize(spark, run):
    assert run(tx.sanitize_text, None, "", " a \n\t b\x00c\xa0d\x1ce ") == ["", "", "a bc d e"]
    df = spark.createDataFrame([("a" * 50 + " " * 10 + "b",)], "t string")
    assert df.select(tx.sanitize_text(F.col("t"), 55)).first()[0] == "a" * 50


def test_redact(run):
    got = run(
        tx.redact_pii,
        "mail joe.x+y@mail.example.org now", "call 555-123-4567 or 555.123.4567 or 5551234567",
        "ssn 123-45-6789", "card 4111 1111 1111 1111 and 4111111111111111", "a@b.c|d", "12-34", "é555-123-4567",
    )
    assert got == [
        "mail [EMAIL] now", "call [PHONE] or [PHONE] or [PHONE]", "ssn [SSN]", "card [CARD] and [CARD]",
        "[EMAIL]", "12-34", "é555-123-4567",
    ]


def test_paths(spark):
    cases = {
        "/base/a.log": True, "a.log": True, "sub/../a.log": True, "../a.log": False, "/base/../etc/a": False,
        "/basement/a": False, "x.EXE": False, "x.tar.sh": False, "/base": True, "./.": True, ".exe": True,
        "a/../../base/b.txt": True, "x.so.log": True, "/base//b.dll": False,
    }
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    got = {r[0]: r[1] for r in df.select("p", tx.flag_unsafe_paths(F.col("p"), "/base/")).collect()}
    assert got == cases


def test_suffix(spark):
    cases = {"/a/b.LOG": ".log", ".log": "", "a.": "", "a.b.txt": ".txt", "/a.b/c": "", "x/.y.log": ".log"}
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    assert {r[0]: r[1] for r in df.select("p", tx.file_suffix(F.col("p"))).collect()} == cases


def test_evidence(spark):
    long = "v" * 600
    cases = [
        ("abc", "abc"), ("x" * 80 + "abc" + "y" * 80, "abc"), ("abc" + "y" * 80, "abc"), ("x" * 80 + "abc", "abc"),
        (long, long), ("nothing", "w" * 300), ("😀" * 60 + "abc" + "é" * 60, "abc"), ("abc " * 40, "abc"),
        ("x" * 90 + "v" * 397 + "y" * 90, "v" * 397), ("x" * 90 + "v" * 398 + "y" * 90, "v" * 398),
    ]
    df = spark.createDataFrame(cases, "t string, v string")
    got = [r[0] for r in df.select(tx.evidence_window(F.col("t"), F.col("v"))).collect()]
    for (t, v), e in zip(cases, got):
        p = t.find(v)
        want = v[:200] if p < 0 else t[max(0, p - 50) : p + len(v) + 50]
        assert e == (want[:497] + "..." if len(want) > 497 else want)


def test_truncate(run):
    got = run(tx.truncate_value, "a" * 1000, "a" * 1001, None)
    assert got == ["a" * 1000, "a" * 997 + "...", None]
