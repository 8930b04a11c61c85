"""Pages whose articles hold what the labelled pages' articles don't, and pages with tags left out."""

from __future__ import annotations

import time

import duckdb
import pytest

from dimlathe.llm import html_extract

LONG = "A long paragraph of an article that says a good deal about things and goes on for a while. " * 3


@pytest.fixture(scope="module")
def model():
    return html_extract.Model([h for (h,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' ORDER BY page_id").fetchall()])


@pytest.mark.parametrize(("page", "blocks"), [
    (
        f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>1<td>2</table><pre>x = 1</pre><blockquote>q</blockquote>"
        "<h2>S</h2><p><a href=x>just a link</a></p></article>",
        [LONG.strip(), "one", "two", "1", "2", "x = 1", "q", "S", "just a link"],
    ),
    ("<article><h1>Notes</h1><p>Ok</p><p>b</p></article>", ["Notes", "Ok", "b"]),
    (f"<head><title>t</title><p>{LONG}", [LONG.strip()]),
    (f"<article><p>a</p><div><button>press<p>hidden</div><p>{LONG}</p></article>", ["a", LONG.strip()]),
    (f"<article><div><button><div>press</div></button><p>{LONG}</p></div></article>", [LONG.strip()]),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>", ["so x=1 holds"]),
    (
        f"<body><nav><ul><li><a href=1>Home</a><li>x</ul></nav><article><p>{LONG}</p><div class=ad><p>buy</p></div></article>"
        f"<aside><p>{LONG}</p></aside><div class='comments'><p>{LONG}</p></div><footer>f</footer>",
        [LONG.strip()],
    ),
    (f"<article><p>{LONG}</p></article><a href=", [LONG.strip()]),
    ("<nav><p>Home</p></nav>", []),
])
def test_articles_are_kept_whole(model, page, blocks):
    assert model.text(page) == "\n\n".join(blocks)


def test_broken_tags_take_seconds(model):
    start = time.time()
    for page in ("<a " * 30_000, "<div>" * 20_000 + "</section></b></div></p>" * 20_000, "<p>x" + "<li>" * 20_000):
        model.text(page)
    assert time.time() - start < 30


def test_clashing_names(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>a</p></article>", "other")], "page_id long, url string, html string, HTML string")
    assert [(r["page_id"], r["text"]) for r in html_extract.extract(pages).collect()] == [(1, "a")]
