"""Text operators: cleaning, tag stripping, redaction, evidence windows, path checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Redaction patterns in order of application, with their placeholders.
REDACTIONS = (
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL]"),
    (r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b", "[PHONE]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
    (r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b", "[CARD]"),
)

# File suffixes that are read, and suffixes that are never safe to open.
SUPPORTED_SUFFIXES = (".txt", ".log", ".pdf", ".doc", ".docx")
DANGEROUS_SUFFIXES = (
    ".exe", ".bat", ".sh", ".ps1", ".dll", ".so", ".app", ".cmd", ".com", ".msi", ".scr",
)

# Work item keys and the label each one gets in the composed text.
WORK_ITEM_PARTS = (
    ("System.Title", "Title: "),
    ("System.Description", "\nDescription: "),
    ("Microsoft.VSTS.TCM.ReproSteps", "\nReproduction Steps: "),
    ("Microsoft.VSTS.Common.AcceptanceCriteria", "\nExpected Behavior: "),
)

# The address pattern in a form that enters each run of address characters once, at the first
# word boundary in it: where that place fails, the later ones of the run fail alike.
_ADDRESS_RUN = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))((?>[A-Za-z0-9._%+-]*?\b))[A-Za-z0-9._%+-]++"
    r"@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
)

EVIDENCE_MARGIN = 50
EVIDENCE_MAX = 497
EVIDENCE_FALLBACK = 200
VALUE_MAX = 1000
ELLIPSIS = "..."


def strip(c: Column) -> Column:
    """Remove leading and trailing white space, Unicode included."""
    return F.btrim(c, F.lit(WHITESPACE))


def fold_case(c: Column) -> Column:
    """Lower case, with the three letters that fold to ASCII letters but do not lower to them."""
    for letter, plain in (("\u017f", "s"), ("\u0131", "i"), ("\u0130", "i")):
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return F.lower(c)


def clean_freetext(c: Column) -> Column:
    """Strip, then keep printable characters, newlines and tabs only."""
    return F.regexp_replace(strip(c), r"[\p{C}\p{Z}&&[^ \n\t]]", "")


def normalize_newlines(c: Column) -> Column:
    """Turn CR LF and lone CR into LF."""
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def drop_invalid_utf8(c: Column) -> Column:
    """Drop bytes that are not UTF-8. A genuine U+FFFD is dropped as well."""
    return F.replace(F.make_valid_utf8(c), F.lit("\ufffd"), F.lit(""))


def strip_html(c: Column) -> Column:
    """Delete tags, decode three entities in fixed order, strip.

    The part after the last ``>`` holds no tag. It is left out of the search, where each ``<``
    in it would cost a scan to the end of the text.
    """
    rest = F.substring_index(c, ">", -1)
    tagged = F.left(c, F.length(c) - F.length(rest))
    c = F.concat(F.regexp_replace(tagged, "<[^>]+>", ""), rest)
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return strip(c)


def compose_work_item(fields: Column) -> Column:
    """Labelled parts of a work item, blank line between parts; empty parts are left out."""
    parts = []
    for key, label in WORK_ITEM_PARTS:
        part = fields[key]
        parts.append(F.when(F.length(part) > 0, F.concat(F.lit(label), part)))
    return F.concat_ws("\n", *parts)


def sanitize_text(c: Column, max_length: int = 100_000) -> Column:
    """Truncate, drop NUL, collapse white space runs to one space. NULL becomes empty."""
    cut = F.replace(F.left(F.coalesce(c, F.lit("")), F.lit(max_length)), F.lit("\x00"), F.lit(""))
    return F.btrim(F.regexp_replace(cut, r"(?U)[\s\x1c-\x1f]+", " "), F.lit(" "))


def redact_pii(c: Column) -> Column:
    """Replace e-mail addresses, phone numbers, SSNs and card numbers, in that order."""
    for pattern, placeholder in REDACTIONS:
        if "@" in pattern:
            redacted = F.regexp_replace(c, "(?dU)" + _ADDRESS_RUN, "$1" + placeholder)
            # Without an @ there is no address, and most texts have none.
            c = F.when(F.contains(c, F.lit("@")), redacted).otherwise(c)
        else:
            c = F.regexp_replace(c, "(?dU)" + pattern, placeholder)
    return c


def file_name(path: Column) -> Column:
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def file_suffix(path: Column) -> Column:
    """Lower-case suffix with its dot; empty for none, for dot files and for a final dot."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def resolve_path(path: Column, base_dir: str) -> Column:
    """Absolute form of a path with ``.`` and ``..`` segments applied.

    The path is taken as text: symbolic links are not followed.
    """
    absolute = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.lit(base_dir.rstrip("/") + "/"), path)
    )
    segments = F.filter(F.split(absolute, "/"), lambda s: (s != "") & (s != "."))
    resolved = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    return F.concat(F.lit("/"), F.array_join(resolved, "/"))


def flag_unsafe_paths(path: Column, base_dir: str) -> Column:
    """True where a path stays inside ``base_dir`` and has no dangerous suffix."""
    base = "/" + "/".join(s for s in base_dir.split("/") if s)
    full = resolve_path(path, base)
    inside = (full == base) | full.startswith(base.rstrip("/") + "/")
    return inside & ~file_suffix(path).isin(*DANGEROUS_SUFFIXES)


def window_at(text: Column, value: Column, at: Column, length: Column) -> Column:
    """The text around a value found at position ``at``; the value's start when not found."""
    start = F.greatest(F.lit(1), at - EVIDENCE_MARGIN)
    window = F.substring(text, start, at + length + EVIDENCE_MARGIN - start)
    return F.when(at > 0, window).otherwise(F.left(value, F.lit(EVIDENCE_FALLBACK)))


def shorten_evidence(c: Column) -> Column:
    return F.when(
        F.length(c) > EVIDENCE_MAX, F.concat(F.left(c, F.lit(EVIDENCE_MAX)), F.lit(ELLIPSIS))
    ).otherwise(c)


def evidence_window(text: Column, value: Column) -> Column:
    """The first place of ``value`` in ``text`` with some context, at most 500 characters."""
    return shorten_evidence(window_at(text, value, F.instr(text, value), F.length(value)))


def truncate_value(c: Column, max_length: int = VALUE_MAX) -> Column:
    """Cut a long value so that it ends in an ellipsis and has ``max_length`` characters."""
    return F.when(
        F.length(c) > max_length,
        F.concat(F.left(c, F.lit(max_length - len(ELLIPSIS))), F.lit(ELLIPSIS)),
    ).otherwise(c)
