from __future__ import annotations

import itertools
import random
import re
import time
from html import unescape

import pyarrow.parquet as pq
import pytest

from stockledger.llm import html as H


def cut_value(source, near, side):
    v = sum(c for c, s in zip(source, side) if c > 0 and not s) + sum(-c for c, s in zip(source, side) if c < 0 and s)
    return v + sum(c for i, row in enumerate(near) for j, c in row.items() if i < j and side[i] != side[j])


@pytest.mark.parametrize("seed", range(40))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    source = [rng.uniform(-3, 3) for _ in range(n)]
    near = [{} for _ in range(n)]
    for i, j in itertools.combinations(range(n), 2):
        if rng.random() < 0.5:
            near[i][j] = near[j][i] = rng.uniform(0, 2.5)
    side = H.minimum_cut(source, [dict(x) for x in near])
    best = min(cut_value(source, near, s) for s in itertools.product([False, True], repeat=n))
    assert abs(cut_value(source, near, side) - best) < 1e-6


def test_articles_of_the_test_pages():
    """The article's blocks, cut out by hand, are the whole text and nothing else."""
    for p in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist():
        article = p["html"][p["html"].index("<article>") + 9 : p["html"].index("</article>")]
        blocks = [" ".join(unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert H.main_text(p["html"]) == "\n\n".join(b for b in blocks if b)


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>if (a < b) { x = "<p>no</p>" }</script><style>p > a {}</style></head>
<body class="has-sidebar"><!-- <p>hidden</p> --><header class="site-header"><a href="/">Home</a> <p>Welcome to the site, dear reader of ours.</p></header>
<div id="cookie-notice"><p>We use cookies to make this site work well for you. Accept them all today.</p></div>
<nav><ul><li><a href="a">One<li><a href="b">Two</a></ul></nav>
<div class="layout with-sidebar"><main><article><header><h1>The   main
 title</h1></header><p>First paragraph of the story, which goes on for a while &mdash; caf&eacute; &#8364;5 &lt;b&gt;.
<p>Second<br>paragraph with a <a href='x>y'>link</a> inside it.<aside class="promo"><p>Buy our product now, it is great and cheap.</p></aside>
<div class="ad-slot">Advert text that is long enough to look like a paragraph of prose.</div>
<ul><li>A point made in the list.<li>Another point made in the list.</ul><blockquote>A quotation, too.</blockquote>
<form><label>Your mail</label><input><button>Subscribe</button></form></article></main>
<div class="sidebar"><p>Related stories that you may like to read after this one.</p></div></div>
<section id="comments"><article class="comment"><p>I think this is a very good article, thank you for writing it.</p></article></section>
<footer>&copy; 2024 Someone. All rights reserved.</footer></body></html>"""


def test_a_page_with_everything():
    assert H.main_text(PAGE) == "\n\n".join([
        "The main title", "First paragraph of the story, which goes on for a while — café €5 <b>.", "Second paragraph with a link inside it.",
        "A point made in the list.", "Another point made in the list.", "A quotation, too."])


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "<script>", "</p></div>", "<a title=\"x>", "&#xD800; &#0; &bogus;", "<p>" * 3000 + "x", "\x00<p>\x00", "<div>" * 2000 + "</div>" * 3000, "<svg><p>a</svg><table><tr><td>b"])
def test_malformed_pages_never_fail(page):
    assert isinstance(H.main_text(page), str)


def test_frame(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", PAGE), (3, "u", PAGE), (None, "v", "<p>" + "A long sentence of plain words, repeated. " * 5000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' as text", "1 as n_chars", "2 as key")
    out = H.extract(df, "html").collect()
    assert len(out) == 5 and out[0].text == "" and out[1].n_chars == 0 and out[2].text == out[3].text == H.main_text(PAGE)
    assert all(r.n_chars == len(r.text) and r.key == 2 for r in out) and out[4].n_chars > 200_000
    assert H.extract(df.where("page_id > 10"), "html").count() == 0


BODY = "This is a long paragraph of the article with enough words to count as content for sure, and then a few more words."


@pytest.mark.parametrize(
    "page, kept",
    [
        (f'<article><h2 id="related-work">Related work</h2><p>{BODY}</p></article>', "Related work"),
        (f'<article><div class="entry-header"><h1>Title one</h1></div><p>{BODY}</p></article>', "Title one"),
        (f'<article><div class="article-header"><h1>Title one</h1></div><p>{BODY}</p></article>', "Title one"),
        (f'<div id="content"><header><h1>Title one</h1></header><p>{BODY}</p></div>', "Title one"),
        (f'<main><p class="share-price">{BODY}</p></main>', "This is a long"),
        (f"<article><p>{BODY}</p><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for all of these things</p></article>", "x=2"),
        (f"<article><p>{BODY} The phrase all rights reserved is used in contracts of many kinds, and it has been for a long time.</p></article>", "reserved is used"),
    ],
)
def test_words_on_headings_and_paragraphs_do_not_remove_them(page, kept):
    assert kept in H.main_text(page) and "enough words" in H.main_text(page)


@pytest.mark.parametrize("page", ['<a "' * 250_000, "<a \"x'>" * 150_000, "<script " * 120_000, '<a "' * 200_000 + ">", "<p>x" + "<!--" * 200_000])
def test_time_grows_with_the_page_s_length(page):
    began = time.process_time()
    H.blocks(page)
    assert time.process_time() - began < 2


def test_what_is_not_closed_goes_on_to_the_end():
    assert H.main_text(f"<article><p>{BODY}</p></article><script>var a = 1 > 0; text()") == BODY
    assert H.main_text(f"<article><p>{BODY}</p></article><!-- > open comment") == BODY
