"""Main text of pages: whole tables against another reading, and pages of other shapes."""

from __future__ import annotations

import html
import re
import time

import pytest

from meterloom.llm.html_extract import extract, main_text
from meterloom.llm.queries import llm_queries

LONG = "A sentence of the article that goes on for quite some words, as articles do, and then it ends."
MORE = "Another paragraph, written by the same author, with a <a href='/x'>link</a> in its midst &amp; more text."


def test_query_equals_another_reading(spark, sf_dir):
    """All pages of the table mark their article, and it holds nothing else."""
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    expected = {}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1).replace("<br>", " ")
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        expected[r["page_id"]] = "\n".join(x for b in blocks if (x := " ".join(b.split())))
    found = llm_queries()["op11_html_extract"](spark, sf_dir).collect()
    assert {r["page_id"]: r["text"] for r in found} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in found)


PLAIN = "A sentence of the article that goes on for quite some words, as articles do, and then it ends."
LINKED = "Another paragraph, written by the same author, with a link in its midst & more text."
CHROME = (
    "<nav><a href=/>Home</a> <a href=/a>About us and our long, long history of publishing</a></nav>",
    "<header><h1>The Daily Site</h1><p>All the news that fits on this site, every single day of the year.</p></header>",
    "<div class='cookie-notice'><p>We use cookies to make this site work, and to learn about its visitors.</p></div>",
    "<div id=sidebar><h3>Popular</h3><p>A teaser for some other story that is long enough to look like one.</p></div>",
    "<aside><p>An aside about something else, which is just as long as a paragraph of the article.</p></aside>",
    "<form><label>Search</label><input><p>Type what you look for, then press the button to search.</p></form>",
    "<div class='advert'>Buy this now, it is cheap and very good, says everyone who has ever bought it.</div>",
    "<script>document.write('<p>No text at all, though it looks like some to a simple reader.</p>')</script>",
    "<style>p:before { content: 'a long text that is no text of the page at all' }</style>",
    "<section id=comments><h3>2 Comments</h3><p>First! I have read all of it, and have much to say about it all.</p></section>",
    "<div role=complementary><p>More stories that you may like to read once you are done with this one.</p></div>",
    "<div class=siteFooter><p>Copyright by the publisher of this site; all rights are reserved, and so on.</p></div>",
    "<footer><p>Imprint, terms and conditions, privacy policy, and a long address of the publisher.</p></footer>",
    "<div style='display: none'><p>Hidden text that only machines will ever read, however long it may be.</p></div>",
    "<noscript><p>Please turn on scripts to see this page as its authors wanted you to see it.</p></noscript>",
)
BODY = f"<h1>A title</h1><p>{LONG}</p><p>Short.</p><p>{MORE}</p><ul><li>One</li><li>Two</li></ul><p>{LONG}"
TEXT = "\n".join(["A title", PLAIN, "Short.", LINKED, "One", "Two", PLAIN])


@pytest.mark.parametrize("around", ["article", "main", "div class=content", "div id=story", "section", "td"])
def test_content_without_its_surroundings(around):
    tag = around.split()[0]
    for shift in range(len(CHROME)):
        parts = [*CHROME[shift:], *CHROME[:shift]]
        page = "".join(parts[:8]) + f"<{around}>{BODY}</{tag}>" + "".join(parts[8:])
        assert main_text(f"<html><head><title>T</title></head><body>{page}</body></html>") == TEXT
        assert main_text(f"<body><div class='page with-sidebar'>{page}</div>") == TEXT


def test_chrome_inside_the_article():
    for part in CHROME:
        if part.startswith("<header"):
            continue
        assert main_text(f"<article><h1>A title</h1>{part}<p>{LONG}</p>{part}<p>{MORE}</article>") == "\n".join(
            ["A title", PLAIN, LINKED]
        )
    headed = f"<article><header><h1>A title</h1><p>by an author</p></header><p>{LONG}</p></article>"
    assert main_text(headed) == f"A title\n{PLAIN}"


def test_short_articles_are_whole():
    menu = "<nav>" + "".join(f"<li><a href=/{i}>Entry {i} of the menu</a></li>" for i in range(30)) + "</nav>"
    assert main_text(f"{menu}<article><h1>Go</h1><p><b>Go.<br></article><footer>{LONG}</footer>") == "Go\nGo."
    assert main_text(f"{menu}<article></article>") == ""
    assert main_text("Just text, no markup") == "Just text, no markup"


def test_broken_markup():
    assert main_text("<article><p>a &lt; b &amp;c &#x41;&nbsp;d<p>e < f<br>g</article><!-- never <p>closed") == (
        "a < b &c A d\ne < f g"
    )
    assert main_text("<nav><ul><li>menu<article><p>text</p></article>") == "text"
    assert main_text("<article><p>a</div></section>b<p class=ad>advert<p>c</article>") == "a\nb\nc"
    assert main_text("<article><![foo]><![if x]>a<!DOCTYPE y><?php z ?></article><p") == "a"
    assert main_text("<article>a<script>var s = '<!--';</script><p>b</article>") == "a\nb"
    assert main_text("<article>a<p>b</article><script>never closed <p>c") == "a\nb"
    assert main_text("") == "" and main_text(" \n ") == "" and main_text("<") == "<"


@pytest.mark.parametrize("piece", ["<a ", "<!-- ", "<p>x", "</", "&", "<div>", "<![", "<b", "x <script>", "<p class='"])
def test_long_pages_take_linear_time(piece):
    began = time.perf_counter()
    main_text("<article><p>" + piece * (400_000 // len(piece)))
    assert time.perf_counter() - began < 20


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "v", "<p>two words"), (2, "v", "<p>two words")]
    schema = "page_id long, url string, html string, text string, n_chars string"
    frame = spark.createDataFrame([(*r, None, None) for r in rows], schema)
    found = sorted(map(str, map(tuple, extract(frame).collect())))
    assert found == sorted(map(str, [(1, "u", "", 0), (None, None, "", 0), *[(2, "v", "two words", 9)] * 2]))
    assert extract(frame.limit(0)).collect() == []
