import re

import numpy as np
import pytest

from isobar.llm import html_text

LONG = "This is a paragraph of some length that tells a story, with commas and words enough to be content. "
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(12)) + "</ul>"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


CASES = {
    "article": (f"<nav>{MENU}</nav><article><h1>Head</h1>{paragraphs(LONG, 'Short.', LONG)}</article><footer>(c)</footer>", ["Head", LONG, "Short.", LONG]),
    "no marks, menu as a plain list": (f"<div>{MENU}</div><div>{paragraphs(LONG, 'Short.', LONG, LONG)}</div><div><a href='/'>Home</a> <a href='/x'>Imprint</a></div>", [LONG, "Short.", LONG, LONG]),
    "names tell": (f"<div class='siteHeader'>{LONG}</div><div class='content'>{paragraphs(LONG, LONG)}</div><div id='cookie-notice'><p>{LONG}</p></div><div class='ad'>{LONG}</div>", [LONG, LONG]),
    "reader comments": (f"<article>{paragraphs(LONG)}</article><section id='comments'><article class='comment'><p>{LONG}</p></article></section>", [LONG]),
    "comments inside": (f"<article>{paragraphs(LONG)}<div class='comments'><p>Me too! {LONG}</p></div></article>", [LONG]),
    "aside, form, script, style": (f"<article>{paragraphs(LONG)}<aside>{LONG}</aside><form><p>{LONG}</p><input><button>Go</button></form><script>var p = '<p>x</p>';</script><style>p {{}}</style><p>End.</p></article>", [LONG, "End."]),
    "end tags left out": (f"<article><h1>Head</h1><p><b>{LONG}<br>more<p>Second<ul><li>one<li>two</ul></article>", ["Head", LONG + "more", "Second", "one", "two"]),
    "advert without its end tag": (f"<div class='ad'>Buy!<article>{paragraphs(LONG)}</article>", [LONG]),
    "cut off": (f"<article>{paragraphs(LONG)}<p>And th", [LONG, "And th"]),
    "references and white space": ("<article><p>a &amp; b&nbsp;&#233;\n\n \t c</p><p> </p><p>&lt;d&gt;</p></article>", ["a & b é c", "<d>"]),
    "hidden": (f"<main><p hidden>{LONG}</p><div style='display: none'>{LONG}</div>{paragraphs(LONG)}</main>", [LONG]),
    "header in an article": (f"<header><p>{LONG}</p></header><article><header><h1>Head</h1></header>{paragraphs(LONG)}</article>", ["Head", LONG]),
    "nothing": ("<nav>x</nav>", []),
}


@pytest.mark.parametrize("name", list(CASES))
def test_pages(name):
    body, want = CASES[name]
    assert html_text.main_text(page(body)) == "\n\n".join(" ".join(w.split()) for w in want)


def line(i, n):
    """A paragraph of n characters of its own."""
    return (f"{i} has words. " + "more of them, " * (n // 14 + 1))[: n - 1] + "."


def test_nested_containers_of_a_region_are_whole():
    few, many = [line(i, 2_000) for i in range(6)], [line(100 + i, 120) for i in range(15)]
    cells = [f"cell {i}" for i in range(30)]
    table = "<table>" + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in zip(cells[::2], cells[1::2])) + "</table>"
    verse = [f"Line {i}" for i in range(10)]
    twenty = [line(i, 200) for i in range(20)]
    bodies = {
        "giant": (f"<section><p>{line(0, 50_000)}</p></section><section>{paragraphs(*twenty)}</section>", [line(0, 50_000), *twenty]),
        "sections": (f"<section>{paragraphs(*few)}</section><section>{paragraphs(*many)}</section>", few + many),
        "table": (paragraphs(*few) + table + paragraphs(*many), few + cells + many),
        "quote": (paragraphs(*few) + f"<blockquote>{paragraphs(*verse)}</blockquote>" + paragraphs(*many), few + verse + many),
    }
    for name, (body, want) in bodies.items():
        for around in ("<article>{}</article>", "<main><div>{}</div></main>", "<div><p>Some words to begin with, and enough of them to count.</p>{}</div>"):
            got = html_text.main_text(page(f"<nav>{MENU}</nav>" + around.format(body))).split("\n\n")
            assert got[-len(want) :] == [" ".join(w.split()) for w in want], (name, around)
            assert len(got) - len(want) == around.count("<p>"), (name, around)


def test_small_containers_beside_a_large_one():
    twenty = [line(i, 200) for i in range(20)]
    for a, b in (("<div>", "</div>"), ("<section>", "</section>"), ("<article>", "</article>")):
        body = f"<div>{MENU}</div>{a}<p>{line(0, 50_000)}</p>{b}{a}{paragraphs(*twenty)}{b}"
        assert html_text.main_text(page(body)).split("\n\n") == [" ".join(w.split()) for w in [line(0, 50_000), *twenty]], a


def test_body_with_text_of_its_own():
    quote = f"<blockquote>{paragraphs('One.', 'Two.')}</blockquote>"
    got = html_text.main_text(page(f"<div>{MENU}</div>{paragraphs(LONG, LONG)}{quote}{paragraphs(LONG)}<div>{MENU}</div>"))
    assert got.split("\n\n") == [LONG.strip(), LONG.strip(), "One.", "Two.", LONG.strip()]


KEPT = {
    "header with a class": f"<header class='entry-header'><h1>Head</h1></header>{paragraphs(LONG)}",
    "section of a paper": f"{paragraphs(LONG)}<section id='discussion'><h2>Discussion</h2>{paragraphs(LONG)}</section>",
    "subjects": paragraphs(LONG) + "".join(
        f"<div class='{name}'><p>{name}</p></div>"
        for name in ("notice", "alert alert-info", "search-results", "related-work", "banner", "cookie-recipes", "market-share", "has-sidebar", "promotion", "social", "header")
    ),
    "roles": f"{paragraphs(LONG)}<div class='alert' role='alert'><p>Mind this.</p></div>",
    "heading's identifier": f"{paragraphs(LONG)}<h2 id='newsletter'>Newsletter</h2>{paragraphs(LONG)}",
}


@pytest.mark.parametrize("name", list(KEPT))
def test_names_within_a_region(name):
    whole = html_text.main_text(page(f"<article>{KEPT[name]}</article>"))
    assert whole == html_text.main_text(page("<article>" + re.sub(" (class|id|role)='[^']*'", "", KEPT[name]) + "</article>"))
    assert html_text.main_text(page(f"<article class='has-comments discussion'>{KEPT[name]}</article>")) == whole


@pytest.mark.parametrize("name", ["ad", "ad-slot", "advertisement", "share-buttons", "socialShare", "newsletter-signup", "comments", "comment-list", "comment-17", "breadcrumbs", "sidebar", "x ad"])
def test_names_that_say_one_thing(name):
    for attribute in ("class", "id"):
        body = f"<article>{paragraphs(LONG)}<div {attribute}='{name}'>{paragraphs(LONG)}</div><p>End.</p></article>"
        assert html_text.main_text(page(body)) == LONG.strip() + "\n\nEnd."


def test_odd_pages():
    for html in ("", "<", "<p", "plain text only", "</div></p>", "<!--", "<![CDATA[x]]>", "<p>" * 5_000, "x" * 300_000):
        assert isinstance(html_text.main_text(html), str)
    assert html_text.main_text("plain text only") == "plain text only"


def test_smoothing_keeps_a_constant():
    assert np.allclose(html_text.smoothed(np.full(7, 3.0)), 3.0)
    assert html_text.smoothed(np.array([0.0, 0, 9, 0, 0]))[1] > 1


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", page(CASES["article"][0]), "x", "y"), (2, None, None, None, None), (None, "u", "", "", ""), (1, "u", page(CASES["article"][0]), "x", "y")]
    got = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 2] == [""]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def test_long_page():
    body = "<article>" + paragraphs(*[LONG] * 5_000) + "</article>"
    assert html_text.main_text(page(body)).count("\n\n") == 4_999
