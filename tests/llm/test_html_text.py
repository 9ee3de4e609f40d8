"""Main text of pages: the tree, the decoding, pages whose article is known."""

import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riftlog.llm import html_text
from riftlog.llm.html_text import MARK, Nodes, decode, extract, fit, layout, read_page, texts_of
from riftlog.llm.queries import op12_html_text

from .common import SF, read


def article(page):
    """The text blocks of the only ``article`` of a page of the given table."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.read.parquet(f"{SF}/pages.parquet"))


def runs(page):
    nodes = Nodes()
    read_page(page, nodes)
    return [t for t in nodes.text if t]


def test_every_page_of_the_table(spark):
    want = {r.page_id: (r.url, article(r.html)) for r in read("pages").itertuples()}
    rows = op12_html_text(spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r["url"], r["text"]) == want[r["page_id"]] and r["n_chars"] == len(r["text"])


def test_reading_of_broken_pages():
    assert runs("<p>a<p>b<ul><li>c<li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert runs("a <b>b<br>c</b>\n\t d&amp;&eacute;&nbsp;&#x41;&am") == ["a b c d&é A&am"]
    assert runs("<script>var x='</p>';</script>a<style>p{}</style><!-- b --><title>t</title>b<!-->c") == ["a bc"]
    assert runs("<table><tr><td>a<td>b<tr><th>c</table>d</div></p>e") == ["a", "b", "c", "d", "e"]
    assert runs('<div class="x>y" id=\'>\'>a</div><div cla') == ["a"]
    assert runs("1 < 2 <3 <a href=x>b</a") == ["1 < 2 <3 b"]
    assert runs("<script>never closed <p>a</p>") == [] == runs("")
    assert runs('<p title="open>a</p><p>b</p>') == ["a", "b"]


def test_depth_and_length():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert runs(deep) == ["x"]
    long = "word " * 400_000
    assert runs(f"<p>{long}</p>") == [long.strip()]


def test_decoding_is_the_likeliest():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 8)
        parent = np.array([-1] + [rng.randrange(i) for i in range(1, n)])
        p = np.array([rng.uniform(0.02, 0.98) for _ in range(n)])
        kids = [[c for c in range(n) if parent[c] == i] for i in range(n)]

        def score(y):
            return sum(np.log(p[i] if y[i] else 1 - p[i]) for i in range(n))

        allowed = [y for y in itertools.product([False, True], repeat=n) if all(not kids[i] or y[i] == any(y[c] for c in kids[i]) for i in range(n))]
        best = max(map(score, allowed))
        got = tuple(decode(parent, p))
        assert got in allowed and abs(score(got) - best) < 1e-9


def test_composed_pages_held_out(model):
    texts = [s for page in read("pages").html for t in runs(page) for s in re.split(r"(?<=[.!?]) ", t) if s]
    rng, exact, n = random.Random(123), 0, 200
    for _ in range(n):
        page = layout(rng, texts)
        want = "\n".join(t for r in runs(page) if MARK in r and (t := r.replace(MARK, "").strip()))
        exact += texts_of([page.replace(MARK, "")], model)[0] == want
    assert exact >= 0.8 * n


PAGE = """<html><head><title>t</title></head><body><header class="site-header"><a href=/>Logo</a><p>The best site.</p></header>
<div id="cookie-consent"><p>We use cookies to improve your experience, please accept them.</p><button>OK</button></div>
<div class="layout"><div class="sidebar"><h3>Popular</h3><ul><li><a href=1>One thing</a></li><li><a href=2>Two things</a></li></ul></div>
<div class="post"><h1>Title of post</h1><p>First paragraph of the post, with <a href=x>a link</a> and words.</p>
<div class="advertisement"><p>Buy this now, it is great.</p></div><p>Second paragraph &amp; more&nbsp;text here.</p>
<form action=/s><label>Subscribe to our letter</label><input name=e><button>Go</button></form><p>Last paragraph.</p></div></div>
<section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I liked this article, thanks for writing it.</p></div></section>
<footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"""
TEXT = "Title of post\nFirst paragraph of the post, with a link and words.\nSecond paragraph & more text here.\nLast paragraph."


def test_a_page_of_another_kind(model):
    assert texts_of([PAGE], model) == [TEXT]


def test_odd_pages(spark, model):
    long = "<article>" + "<p>Some words, again and again.</p>" * 60_000 + "</article>"
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, None, "", "x"), (3, "u", "\n \t", None), (4, "u", long, "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, row string").withColumn("n_chars", F.lit("clash"))
    got = {(r["row"]["page_id"], r["text"]) for r in extract(frame, model).collect()}
    assert extract(frame, model).count() == 6
    assert got == {(1, TEXT), (None, ""), (2, ""), (3, ""), (4, "\n".join(["Some words, again and again."] * 60_000))}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(frame, fit(frame)).count() == 0
    blank = spark.createDataFrame([("a", None)], "page_id string, html string")
    assert extract(blank, fit(blank)).select("text", "n_chars").collect() == [("", 0)]
