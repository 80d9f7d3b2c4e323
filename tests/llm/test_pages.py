import re
import time

import duckdb
import pytest

from tessera.llm import html_text
from tests.conftest import SF

GOOD = [f"Paragraph {k} of the page has words, some commas, and it ends here." for k in range(4)]
ODD = "Another paragraph, much like the four, which stands in an element of a class."


def page(inner, around="div"):
    return f"<body><nav><a>menu</a></nav><{around}>{''.join(f'<p>{x}</p>' for x in GOOD)}{inner}</{around}><footer>foot</footer></body>"


@pytest.mark.parametrize("around", ["div", "article"])
@pytest.mark.parametrize("name", ["c1", "share-price", "related-work", "job-search", "alert-history", "social-history", "advert-analysis"])
def test_a_name_alone_is_no_verdict(around, name):
    assert html_text.main_blocks(page(f'<div class="{name}"><p>{ODD}</p></div>', around)) == [*GOOD, ODD]


@pytest.mark.parametrize("around", ["div", "article"])
@pytest.mark.parametrize("name", ["alert", "comments", "related-posts", "share-buttons", "cookie-notice", "sidebar", "newsletter-form", "reader-comments"])
def test_what_the_names_and_the_scores_say_goes(around, name):
    assert html_text.main_blocks(page(f'<div class="{name}"><p>{ODD}</p></div>', around)) == GOOD


def test_links_in_prose_stay():
    for around in ("div", "article"):
        for inner, text in (("<p><a>A paragraph that is one link, as a whole.</a></p>", "A paragraph that is one link, as a whole."), ("<p>See the report <a>" + " " * 90 + "here" + "\n" * 90 + "</a> for all of it.</p>", "See the report here for all of it.")):
            assert html_text.main_blocks(page(inner, around)) == [*GOOD, text]
        assert html_text.main_blocks(page("<ul>" + "<li><a>An entry of a menu</a></li>" * 5 + "</ul>", around)) == GOOD


@pytest.mark.parametrize("start, end", [("<div>", ""), ("<div>", "</div>"), ("<div class=ad>", ""), ("<b>", "</i>"), ("<li><div>", ""), ("<article>", ""), ("<div>", "</section>"), ("<div><article></article>", ""), ("<b><p></p>", ""), ("<a><div><b>", "</a>"), ("<table><tr><td>", "")])
def test_deep_pages_take_linear_time(start, end):
    began = time.process_time()
    blocks = html_text.main_blocks((start + "word, text. ") * 20_000 + end * 20_000)
    assert time.process_time() - began < 6
    assert blocks is not None


def test_twenty_thousand_open_divs():
    began = time.process_time()
    assert html_text.main_blocks("<div>" * 20_000 + "Deep text, here.") == ["Deep text, here."]
    assert time.process_time() - began < 2


def test_names_are_not_needed_for_most_pages():
    pages = [h for (h,) in duckdb.sql(f"SELECT html FROM '{SF.replace('0.001', '0.01')}/pages.parquet'").fetchall()]
    bare = [re.sub(r'\s(class|id|role)="[^"]*"', "", re.sub(r"<(/?)(article|main)\b", r"<\1div", h)) for h in pages]
    assert sum(html_text.main_blocks(a) == html_text.main_blocks(b) for a, b in zip(pages, bare, strict=True)) >= 246
