import pytest

from bugsieve.llm import html
from tests.llm.test_html import LONG

STORY = LONG.strip()


def test_a_teaser_is_not_the_page():
    page = f"<body><div>{LONG}</div><div>{LONG}</div><nav>x</nav><article class='card'><p>Read on</p></article></body>"
    assert html.main_text(page) == f"{STORY} {STORY}"


@pytest.mark.parametrize("beside", [
    "<div>Copyright 2024 Acme Corp</div><div>Contact us</div>",
    "<div>Acme Daily</div><div>Monday edition</div>",
    "<div>You might also read <b>Ten more stories</b> that others liked this week on our pages</div>",
    "<p>All rights reserved.</p>" * 3,
])
def test_lines_beside_the_article_are_no_text(beside):
    article = f"<article><h1>Title</h1>{f'<p>{LONG}</p>' * 4}<p>So it ended.</p></article>"
    text = " ".join(["Title", *[STORY] * 4, "So it ended."])
    for page in (beside + article, article + beside, beside + article + beside):
        assert html.main_text(f"<html><body>{page}</body></html>") == text


def test_a_story_beside_a_small_article_is_text():
    story = f"<div>{LONG * 4}</div>" * 6
    page = f"<body>{story}<article><p>Read on</p></article><div>Contact us</div></body>"
    assert html.main_text(page) == " ".join([STORY] * 24)


def test_an_advert_within_the_text_is_no_dive():
    page = f"<body><p>{LONG}</p><div class='ad'>Buy</div><p>So it ended.</p><nav>x</nav><p>Other</p></body>"
    assert html.main_text(page) == f"{STORY} So it ended."
