"""Main text: labels of the cut, page parts, broken markup."""

from __future__ import annotations

import itertools
import random
import time

from claimlens.llm import main_text as M

PAGE = """<!DOCTYPE html><html><head><title>no &amp; no</title><style>p{}</style></head><body class="has-sidebar">
<div id="cookie-banner">We use cookies</div><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>
<main><div class="post-content"><h1>Title &amp; more</h1><p>First para.<br>line   two</p><div class=ad>Buy now</div>
<p>Second <a href=q>link</a> para &eacute; here.<form><label>Mail</label><input></form><script>var a = "</p>";</script>
<aside>Side</aside><ul><li>one<li>two</ul></div><section id="comments"><h2>Comments</h2>
<p>Great post, I like this very much!</p></section></main><div class="related"><a>x</a></div><footer>c</footer><!-- open"""


def test_parts_of_a_page():
    assert M.main_text(PAGE) == "Title & more\nFirst para. line two\nSecond link para é here.\none\ntwo"


def test_without_article_element():
    story = "<p>" + "A long sentence of the story that goes on for a good while, " * 3 + "and ends.</p>"
    page = f'<div class="top menu"><a>Home</a> <a>News</a></div><div>{story}<p>Short one.</p>{story}</div><div>&copy; Me</div>'
    lines = M.main_text(page).split("\n")
    assert len(lines) == 3 and lines[1] == "Short one."


def test_broken_markup_and_nothing():
    assert M.main_text(None) == M.main_text("") == M.main_text("<!-- only") == M.main_text("<script>x") == ""
    assert M.main_text("<article><p>open <b>bold<p>next") == "open bold\nnext"
    assert M.main_text("<article>" + "<p>a &lt;b&gt;" * 5000) == "\n".join(["a <b>"] * 5000)
    assert M.main_text('<article><p title="a > b\'>c">x</p><p class="d>e</p>') != ""


def _cut(scores, edges, labels):
    cost = sum(max(s, 0) for s, keep in zip(scores, labels) if not keep)
    cost += sum(max(-s, 0) for s, keep in zip(scores, labels) if keep)
    return cost + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_cut_is_minimal():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(1, 8)
        scores = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        best = min(_cut(scores, edges, labels) for labels in itertools.product((False, True), repeat=n))
        assert _cut(scores, edges, M.source_side(scores, edges)) == best


def test_every_page_row(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], "page_id long, url string, html string")
    for docs in (pages, odd, pages.limit(0)):
        rows = M.extract(docs).collect()
        assert len(rows) == docs.count()
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
    for r in M.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        assert r["text"] and "example" not in r["text"].split("\n")[-1]


def test_deep_nesting_costs_no_more_than_its_length():
    for page in (
        "<div>" * 17_000 + "The text." + "</section>" * 5_000 + "</div>" * 5_000,
        "".join(f"<div><p>Words of block {i}.</p>" for i in range(6_000)),
    ):
        assert len(page) > 150_000
        start = time.perf_counter()
        M.main_text(page)
        assert time.perf_counter() - start < 3  # about 0.3 s; before, minutes


def test_inherited_kinds_end_at_the_article():
    page = (
        "<div class=sidebar><article class=post><p>First words of the article, a whole sentence.</p>"
        "<div class=ads><p>Buy this now, it is cheap today.</p></div></article></div><header><p>Head of the page.</p></header>"
    )
    assert M.main_text(page) == "First words of the article, a whole sentence."
