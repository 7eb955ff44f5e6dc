import pytest

from bugsieve.llm import html

LONG = "A sentence of the story that runs on for a good while so that the window is long enough. "

CASES = {
    "article": (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><article><h1>Head</h1>"
        "<p>One&nbsp;&amp;  two<b>bold</b>\n three<br>four<p>Five</article><footer>foot</footer>",
        "Head One & twobold three four Five",
    ),
    "script with markup": ("<article><script>var t='</p>';a<b</script><p>x</p><!-- <p>no</p> --></article>", "x"),
    "inside an article": (
        "<main><header>Site</header><p>Text</p><aside>Side</aside><form><p>Form</p></form><div class='ad box'>Buy</div>"
        "<p>More</p><section id=comments><p>Nice!</p></section></main>",
        "Text More",
    ),
    "no article": (
        f"<body><div class=menu><a href=1>One</a></div><div><a href=2>Two</a></div><div></div><h1>Title</h1><p>{LONG}</p><p>Short.</p>"
        f"<p>{LONG}</p><div class='cookie-notice'>Cookies</div><div>Copyright</div></body>",
        f"Title {LONG.strip()} Short. {LONG.strip()}",
    ),
    "layout names": ("<body class='with-sidebar'><article class='has-comments'><p class='no-ad'>Kept</p></article></body>", "Kept"),
    "comments as articles": ("<article class='post category-social'><p>a</p><article class='comment'><p>b</p></article><p>c</p></article>", "a c"),
    "headers": ("<div class=main-header>Site</div><article><div class='entry-header'><h1>Title</h1></div><div class='header'>x</div><p>y</p></article>", "Title y"),
    "hidden": ("<article><p hidden>a</p><p style='display: none'>b</p><p aria-hidden=true>c</p><p>d</p></article>", "d"),
    "role": ("<article><div role=navigation>a</div><p>b</p></article>", "b"),
    "references": ("<article><p>&lt;p&gt; &eacute; &#233; &#x1F600; &unknown; &copy 5</p></article>", "<p> é é 😀 &unknown; © 5"),
    "broken": ("<article><p>a < b and <b>c</i></b><p>d</article", "a < b and c d"),
    "unclosed": ("<article><p>text", "text"),
    "short": ("<p>tiny</p>", "tiny"),
    "only menus": ("<nav>a</nav><footer>b</footer>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_layouts(name):
    page, text = CASES[name]
    assert html.main_text(page) == text


def test_surge_and_dive():
    page = f"<div>Menu</div><div></div><hr><nav>x</nav><p>{LONG}</p><p>Last.</p><nav>x</nav><p>Other</p>"
    assert html.main_text(page) == f"{LONG.strip()} Last."


def test_long_pages_take_linear_time():
    for piece in ("<p>a", "<", "<div class='", "<!--", "<script>", "&amp;", "</b>", "<a href='", "<b><i>", "< ", "<a '\">"):
        html.main_text("<article>" + piece * 60_000)


def test_frames(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    extra = [(-1, None, None), (None, "u", ""), (-2, "v", "<article><p>x  y</p></article>"), (-2, "v", "<article><p>x  y</p></article>")]
    pages = pages.unionByName(spark.createDataFrame(extra, pages.schema)).selectExpr("*", "1 AS text", "2 AS n_chars")
    rows = html.extract_main_text(pages).collect()
    assert len(rows) == pages.count()
    assert all(r.n_chars == len(r.text) for r in rows)
    texts = {(r.page_id, r.url): r.text for r in rows}
    assert texts[-1, None] == texts[None, "u"] == "" and texts[-2, "v"] == "x y"
    import html as references
    import re
    for r in pages.where("page_id >= 0").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = references.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", inner)))
        assert texts[r.page_id, r.url] == " ".join(plain.split())
    assert html.extract_main_text(pages.limit(0)).count() == 0
