"""Main text of pages against pages built from known content."""

import html
import random
import time

import pytest

from souklake.llm import html_text
from souklake.llm.queries import QUERIES

LONG = "Some sentence here, with commas and stops. It goes on; and on, for a while."
P = f"<p>{LONG * 3}</p>"
TEXT = LONG * 3


def sentence(draw, least, most):
    words = ["".join(draw.choices("abcdeéß中&<", k=draw.randrange(2, 9))) for _ in range(draw.randrange(least, most))]
    return ", ".join(" ".join(words[i : i + 5]) for i in range(0, len(words), 5)) + "."


def built(draw):
    """A page whose wrapper and boilerplate have no telling names, and its text."""
    blocks, text = [], []

    def add(tag, words, inner=None):
        words = " ".join(words.split())
        text.append(words)
        shown = html.escape(words).replace(" ", draw.choice([" ", "\n ", "\t"]), 1)
        if inner:
            first, _, rest = shown.partition(" ")
            shown = f"<{inner}>{first}</{inner}> {rest}"
        blocks.append((tag, f"<{tag}>{shown}" + ("" if tag in ("p", "li") and draw.random() < 0.3 else f"</{tag}>")))

    add("h1", sentence(draw, 3, 6))
    for _ in range(draw.randrange(3, 7)):
        add("p", sentence(draw, 40, 90), draw.choice([None, "b", "em", "label"]))
        if draw.random() < 0.3:
            add("h2", sentence(draw, 2, 4))
            add("p", sentence(draw, 40, 90))
    add("blockquote", sentence(draw, 2, 4))
    add("p", sentence(draw, 40, 60))
    body = "".join(f"<ul>{shown}</ul>" if tag == "li" else shown for tag, shown in blocks)
    holder = draw.choice(["article", "main", "div", 'div class="q1"', 'div class="has-sidebar"', 'article class="post legal-analysis"'])
    links = "".join(f'<a href="/{i}">Link {i}</a> ' for i in range(draw.randrange(3, 9)))
    before = f'<div class="a1">{links}</div><ul class="a2">' + "".join(f"<li><a href=x>Entry {i}</a></li>" for i in range(5)) + '</ul><div class="a3">Buy it now</div>'
    after = '<section class="comments-area"><h2>Comments</h2><article class="comment-body"><p>I think so too, yes.</p></article></section><div class="z">All rights</div>'
    page = f'<html><head><title>x</title><script>"</p>"</script></head><body class="home has-sidebar">{before}<{holder}>{body}</{holder.split()[0]}>{after}</body></html>'
    return page, "\n".join(text)


def test_built_pages_give_their_text():
    draw = random.Random(11)
    for _ in range(300):
        page, text = built(draw)
        assert html_text.extract(page) == text


def test_scores_decide(monkeypatch):
    pages = [built(random.Random(i))[0] for i in range(50)]
    scored = [html_text.extract(page) for page in pages]
    every = lambda page, threshold=0: ({page.paths[e] for e, *_ in page.pieces}, set())
    monkeypatch.setattr(html_text, "content_paths", every)
    assert all(html_text.extract(page) != text for page, text in zip(pages, scored))


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="home has-sidebar">{P}</body>',
        f'<div class="header-fixed">{P}</div>',
        f'<article class="post legal-analysis">{P}</article>',
        f'<div class="search-results">{P}</div>',
        f'<div id="comments">{P}</div>',
        f'<form id="aspnet"><h1></h1>{P}<input></form>',
        f'<div class="nav"></div>{P}<div class="footer">Some site, of us.</div>',
        f"<nav><a href=x>Home</a></nav>{P}<footer>&copy; us",
        f"<head><title>t</title>{P}",
        f"<noscript>{P}",
        f"<template>{P}",
        f"<svg/>{P}",
        f"<svg><text>no</text></svg>{P}",
        f"<i title=a'b></i>{P}",
        f'<i title="a></i>{P}',
        f"{P}<p hidden>no</p><p aria-hidden=true>no</p><p style='display: none'>no</p><p class='",
    ],
)
def test_wrappers_and_odd_markup_lose_nothing(page):
    assert html_text.extract(page) == TEXT


def test_content_keeps_its_short_blocks():
    page = f"<article>{P}<ul><li>One</li><li>Two</li></ul><blockquote>Ah.</blockquote><p>A <label>word</label> here</p>{P}<h2>Read</h2><ul><li><a href=x>this one</a></ul></article>"
    assert html_text.extract(page) == f"{TEXT}\nOne\nTwo\nAh.\nA word here\n{TEXT}"
    last = f"<article>{P}<p>End.</p><p class=ad>Buy, now.</p><div class=cookie-banner>We use cookies.</div></article><article class=teaser>Next</article>"
    assert html_text.extract(last) == f"{TEXT}\nEnd."


@pytest.mark.parametrize("page", ["<a b='", "<", "<b>", "<div>", "<ul><li>", "<!--", '<a ="', "<form>", "<p class=ad>x"])
def test_time_is_linear(page):
    started = time.process_time()
    html_text.extract(page * 50_000 + "</i>" * 50_000)
    assert time.process_time() - started < 10


def test_query(spark, tmp_path):
    rows = [(1, "u", None), (2, None, ""), (3, "u", f"<article>{P}"), (3, "u", f"<article>{P}"), (4, "u", "<p>中 🙂&amp;</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["op6_main_text"](spark, str(tmp_path))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    want = [(1, "u", "", 0), (2, None, "", 0), (3, "u", TEXT, len(TEXT)), (3, "u", TEXT, len(TEXT)), (4, "u", "中 🙂&", 4)]
    assert sorted(map(tuple, found.collect())) == want
    assert html_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
