"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines of a sliding window, and the characters in it with which the text surges.
WINDOW_LINES, SURGE_CHARS = 3, 86

_RAW = "script|style|noscript|template|textarea|select|iframe|object|svg|canvas|audio|video|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_STRIPPED_TAGS = frozenset("head nav header footer aside form button dialog menu fieldset".split())
_STRIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
_STRIPPED_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement adsense sponsor sponsored promo promotion nav navbar navigation "
    "menu menubar sidebar footer masthead topbar toolbar breadcrumb breadcrumbs pagination pager cookie cookies "
    "consent gdpr notice notices alert alerts announcement popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended widget widgets comment comments commentlist respond "
    "disqus reply replies banner".split()
)
#: What stands within a text, and leaves no empty lines when it is stripped.
_WITHIN = frozenset(
    "ad ads adbox adslot advert adverts advertisement adsense sponsor sponsored promo promotion newsletter "
    "subscribe subscription share sharing social related recommended widget widgets".split()
)
#: A header with one of these words is the head of the text itself.
_OWN_HEADER = frozenset("article entry post content story section".split())
#: Articles of these classes are not the page's text.
_STRIPPED_ARTICLES = frozenset("comment comments reply related ad advert promo sponsored".split())
#: Words that say of a name that it tells layout or topic, not what the element is.
_LAYOUT = frozenset("with without has no category tag type status format".split())
_MAIN = frozenset(("article", "main"))
_ROOT = frozenset(("html", "body", "main"))


def _is_stripped(tag: str, attributes: str) -> bool:
    if tag in _STRIPPED_TAGS:
        return True
    if not attributes or tag in _ROOT:
        return False
    article = tag == "article"
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value in _STRIPPED_ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = set(re.split(r"[-_]+", word))
                named = parts & _STRIPPED_NAMES or ("header" in parts and not parts & _OWN_HEADER)
                if word in _STRIPPED_ARTICLES if article else named and not parts & _LAYOUT:
                    return True
    return False


def _is_within(attributes: str) -> bool:
    """Whether a stripped element is of the kind that interrupts a text and does not end it."""
    return any(
        name.lower() in ("class", "id") and set(re.split(r"[-_\s]+", (a or b or c).lower())) & _WITHIN
        for name, a, b, c in _ATTRIBUTE.findall(attributes)
    )


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """The page as lines (text, characters in links, in an article): a line for each block.

    Menus, forms and the like are markup and leave as many empty lines as a window has; adverts
    and the like, which interrupt a text, leave none.
    """
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool]] = []  # tag, stripped, main
    open_tags: dict[str, int] = {}
    stripped = main = links = 0

    def close_line() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                lines.append((text, min(linked, len(text)), main > 0))
            parts.clear()
        linked = 0

    for token in _TOKEN.finditer(page):
        tag, piece = token["tag"], token[0]
        if tag is None:
            if token["raw"] or piece.startswith(("<!", "<?", "</")) or (piece[0] == "<" and len(piece) > 1):
                continue
            if not stripped:
                parts.append(piece)
                if links:
                    linked += len(piece)
            continue
        tag = tag.lower()
        block = tag not in _INLINE
        if block and not stripped:
            close_line()
        if piece[1] == "/":
            if not open_tags.get(tag):
                continue
            while True:
                name, was_stripped, was_main = stack.pop()
                open_tags[name] -= 1
                stripped -= was_stripped
                main -= was_main
                links -= name == "a"
                if name == tag:
                    break
            continue
        if tag == "body":
            stack.clear()
            open_tags.clear()
            stripped = main = links = 0
        if tag in _VOID or piece.endswith("/>"):
            continue
        if tag == "a" and links:
            continue
        hide = _is_stripped(tag, token["attributes"])
        if hide and not stripped:
            close_line()
            if not _is_within(token["attributes"] or ""):
                lines.extend([("", 0, main > 0)] * WINDOW_LINES)
        stack.append((tag, hide, tag in _MAIN))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        stripped += hide
        main += tag in _MAIN
        links += tag == "a"
    if not stripped:
        close_line()
    return lines


def main_text(page: str | None) -> str:
    """The text between surge and dive points of the page's line-block distribution.

    A window's length is the sum over its lines, where a line that is mostly link counts as
    empty outside of article and main elements. The text surges at a window of some length and dives
    at the first empty window; lines from surge to dive are kept. Lines in article or main elements and
    other lines never share a window, and a text ends where they meet. With share s of the page's
    characters in such elements, their lines surge at ``SURGE_CHARS`` to the power of 1 - s, and the
    others at its power of 1 + s: one character is a surge where the article is the whole page, site names
    and closing lines beside it are none, and a teaser counts little more than other lines. If no
    window is that long, the longest for its kind marks the surge.
    """
    lines = lines_of(page or "")
    total = sum(len(text) for text, _, _ in lines)
    share = sum(len(text) for text, _, main in lines if main) / max(1, total)
    need = {True: round(SURGE_CHARS ** (1 - share), 6), False: round(SURGE_CHARS ** (1 + share), 6)}
    lengths = [len(text) if main or 2 * linked <= len(text) else 0 for text, linked, main in lines]
    windows = []  # as parts of the length that is a surge
    for i, (_, _, main) in enumerate(lines):
        size = 0
        for k in range(i, min(i + WINDOW_LINES, len(lines))):
            if lines[k][2] != main:
                break
            size += lengths[k]
        windows.append(size / need[main])
    if not windows or not max(windows):
        return ""
    surge = min(1.0, max(windows))
    kept: list[str] = []
    run: list[str] = []  # lines since the surge; links at either end of them are no text
    inside = before = False
    for (text, _, main), own, window in zip(lines, lengths, windows, strict=True):
        if main != before:
            inside, before, run = False, main, []
        inside = window >= surge or (inside and window > 0)
        if inside and text and (own or run):
            run.append(text)
            if own:
                kept += run
                run = [""]
        elif not inside:
            run = []
    return " ".join(filter(None, kept))


def extract_main_text(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html"
) -> DataFrame:
    """The ``keep`` columns, text and n_chars of every page, from its whole HTML.

    A null or empty page, or one without text, has an empty text; broken markup never fails.
    Repeated rows stay, an empty table gives no rows, other columns are ignored.
    """
    rows = pages.select(*keep, F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, type=pa.string()), pa.array(map(len, texts), type=pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    schema = T.StructType(
        [*rows.schema.fields[: len(keep)], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return rows.mapInArrow(run, schema)
