"""Pages of many shapes with the text that their article holds, broken markup, and speed on hostile pages."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestor.llm import html_extraction as he

LONG = "A sentence of the article, with some words in it. Another one follows, as in prose; it goes on!"
MORE = "Second paragraph: it has commas, stops and words. Nothing in it is a link."
CHROME = '<nav><ul><li><a href="/">Home</a><li><a href="/x">Items</a></ul></nav>'


def text(page):
    return he.extract_page(page)[0]


CASES = {
    "none": (None, ""),
    "empty": ("", ""),
    "blank": (" \n\t ", ""),
    "plain text": ("just words & more", "just words & more"),
    "article": (f"<html><head><title>T</title></head><body>{CHROME}<article><h1>Head</h1><p>{LONG}</p><p>Short</p></article><footer>Foot. Foot.</footer>", f"Head {LONG} Short"),
    "short article, long advert": (f"<div class='ad'>{LONG} {MORE}</div><article><p>Be.</p></article>", "Be."),
    "short article, long part without a name": (f"<div>{LONG} {MORE}</div><article><p>Be.</p></article>", "Be."),
    "no article": (f"<body><div id=menu><a href=1>One</a></div><div id=content><h1>Head</h1><p>{LONG}</p><p>{MORE}</p><p>End</p></div><div class=sidebar>{LONG}</div></body>", f"Head {LONG} {MORE} End"),
    "divisions": (f"<div><div><a href=1>a</a><a href=2>b</a></div><div><div>{LONG}</div><div>Tiny</div><div>{MORE}</div></div><div>(c)</div></div>", f"{LONG} Tiny {MORE}"),
    "heading before": (f"<div><h1>Head</h1><div class=meta>by A</div><div class=text><p>{LONG}</p><p>{MORE}</p></div></div>", f"Head {LONG} {MORE}"),
    "wrapped in a form": (f"<form action=x><input value=q><h1>Head</h1><p>{LONG}</p><select><option>1</select></form>", f"Head {LONG}"),
    "form in an article": (f"<article><p>{LONG}</p><form><label>Mail</label><button>Go</button></form><p>{MORE}</p></article>", f"{LONG} {MORE}"),
    "comments": (f"<article><p>{LONG}</p></article><section id='comments'><article class='comment'><p>{MORE} {MORE} {MORE}</p></article></section>", LONG),
    "comments in the article": (f"<main><article><p>{LONG}</p><ol class='comment-list'><li>{MORE}</ol></article></main>", LONG),
    "notices": (f"<div class='cookie-notice'>{MORE}</div><div role=alert>{MORE}</div><main><h1>Head</h1><p>{LONG}</p></main>", f"Head {LONG}"),
    "classes that say with": (f"<div class='content with-sidebar no-ads'><p>{LONG}</p><p>{MORE}</p></div>", f"{LONG} {MORE}"),
    "name of a wrapper": (f"<div class='sidebar-layout'><article><p>{LONG}</p></article></div>", LONG),
    "page header, article header": (f"<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>{LONG}</p><footer>Tags: a, b.</footer></article>", f"Head {LONG}"),
    "two articles": (f"<main><article><p>{LONG}</p></article><article><p>{MORE}</p></article></main>", f"{LONG} {MORE}"),
    "scripts and styles": (f"<article><p>{LONG}</p><script>if (a<b) x('</p><p>no</p>');</script><style>p>a{{}}</style><noscript>no</noscript><template><p>no</p></template><p>{MORE}</p></article>", f"{LONG} {MORE}"),
    "script in a word": (f"<article><p>be<script>x</script>fore. {LONG}</p></article>", f"before. {LONG}"),
    "references": ("<article><p>&lt;p&gt; &amp;amp; &copy 2020&nbsp;&#8212;&#x1F600;&#0000000000065;&#99999999999;&bogus; &am<b></b>p;</p></article>", "<p> &amp; © 2020 —\U0001f600A�&bogus; &amp;".replace("&amp;amp;", "&amp;")),
    "white space": ("<article><p> a \n\t b<br>c </p>\n<p>d　e</p></article>", "a b c d e"),
    "inline": ("<article><p>un<b>bro</b>ken <a href=x>link</a>s, <i>yes</i>.</p></article>", "unbroken links, yes."),
    "unclosed": (f"<article><h1>Head<p><b>{LONG}<p>{MORE}<ul><li>one<li>two</ul>", f"Head {LONG} {MORE} one two"),
    "misnested": (f"<article><p><b><i>{LONG}</b></i> tail</p></b><p>{MORE}</p></div></article>", f"{LONG} tail {MORE}"),
    "table": (f"<article><p>{LONG}</p><table><tr><td>a<td>b<tr><td>c</div></table>{MORE}</article>", f"{LONG} a b c {MORE}"),
    "comment": (f"<article><p>{LONG}<!-- <p>no</p> --!> --> on</p><!-->{MORE}</article>", f"{LONG} on {MORE}"),
    "unclosed comment": (f"<article><p>{LONG}</p><!-- no <p>no", LONG),
    "unclosed quote": (f"<article><p>{LONG}</p><p title=\"no>no", LONG),
    "quotes and signs": (f"<article><p title='a>b' data-x=\"<p>\" y=a'b>{LONG}</p><p>1 < 2 <3 </ x> & so</p></article>", f"{LONG} 1 < 2 <3 & so"),
    "capitals": (f"<ARTICLE><SCRIPT>no</SCRIPT ><P CLASS=x>{LONG}</P></ARTICLE>", LONG),
    "after the body": (f"<body><article><p>{LONG}</p></body></html><p>{MORE}</p></article>", f"{LONG} {MORE}"),
    "hidden in a sidebar": (f"<aside>{MORE}</aside><article><p>{LONG}</p><aside>{MORE}</aside></article>", LONG),
    "only links": ("<body><div><a href=1>One</a> <a href=2>Two</a></div></body>", "One Two"),
    "only a menu": (CHROME, ""),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    page, want = CASES[name]
    assert text(page) == want


def test_ratios():
    """Means by path, in page order, smoothed: prose stands out from what is short and unpunctuated."""
    path = np.array([1, 1, 1, 2, 2, 2, 2, 3, 3, 3])
    length = np.array([5, 5, 5, 200, 10, 300, 250, 4, 4, 4], float)
    marks = np.array([0, 0, 0, 6, 0, 9, 8, 0, 0, 0], float)
    score = he.ratios(path, length, marks)
    assert (score[3:7] > 10 * score[[0, 1, 8, 9]].max()).all()
    assert he.ratios(np.array([7]), np.array([3.0]), np.array([1.0])).tolist() == [6.0]


@pytest.mark.parametrize(
    "page",
    ["<div>" * 60_000 + "deep", "<p>" * 60_000, "<!--" * 100_000, "<a " * 100_000, "<" * 300_000, "</p " * 100_000, "&#" * 200_000, "<b>" * 60_000 + "x" + "</i>" * 60_000, "<script>" * 60_000, '<p a="' * 60_000, "<p " + "a=1 " * 100_000 + ">x", "<li><ul>" * 20_000, "<td></div>" * 20_000],
    ids=range(13),
)
def test_hostile_pages_take_linear_time(page):
    began = time.perf_counter()
    he.extract_page(page)
    assert time.perf_counter() - began < 15


def test_table(spark):
    rows = [(i, f"u{i}", page) for i, (page, _) in enumerate(CASES.values())] + [(None, None, CASES["article"][0])] * 2
    rows.append((-1, "long", f"<article>{'<p>' + LONG + '</p>' * 1}{'<p>words, words.</p>' * 60_000}</article>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_leaves", "2 as `a.b`")
    got = he.extract(df, keep=("page_id", "text", F.col("`a.b`"))).collect()
    assert len(got) == len(rows)
    assert all(r["a.b"] == 2 and (r["page_id"] is None or r["page_id"] < 0 or r["text"] == list(CASES.values())[r["page_id"]][1]) for r in got)
    assert [r["text"] for r in got if r["page_id"] is None] == [CASES["article"][1]] * 2
    assert [len(r["text"]) for r in got if r["page_id"] == -1] == [len(LONG) + 60_000 * 14]
    assert he.extract(df.limit(0)).collect() == []
