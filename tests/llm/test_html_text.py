"""Main text of pages: trees of broken markup, the choice over a tree, and what a fitted model keeps."""

import itertools
import random
import re
import sys
from html import unescape
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from samples import CLASHES, prose  # noqa: E402

from siltstone.llm import boosting, dom, html_text  # noqa: E402

SF = Path("/root/testdata/sf0.001/pages.parquet")
PAGES = f"page_id bigint, url string, html string, text string, n_chars string, __html2 string, {CLASHES}"
_EXTRA = ("x",) * (3 + len(CLASHES.split(",")))


def pages_frame(spark, rows):
    # A column named text would clash with the result's.
    return spark.createDataFrame([(i, f"u{i}", h, *_EXTRA) for i, h in rows], PAGES)


def whole(html):
    tree = dom.parse(html)
    return dom.kept_text(tree, [True] * len(tree.parent))


@pytest.mark.parametrize("html, text", [
    ("<p><b>One<br><p>two</p>three", "One\ntwo\nthree"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "a\nb\nc\nd\ne"),
    ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
    ('<script>var t="</p>";</script>x<style>p{}</style>y<!-- z -->', "xy"),
    ("<head><title>no</title></head>a&amp;b &lt;i&gt; &eacute;&#8364;&nbsp; c", "a&b <i> é€ c"),
    ("a <i>b</i>c<span>d</span> <a href=x>e</a>\n\t f", "a bcd e f"),
    ("</p></div>a</b><div>b</div></div>c", "a\nb\nc"),
    ("<p>a<span class=ad>b</p>c</span>d", "ab\ncd"),
    ("a<br/>b<hr>c<img alt=z>d<p/>e", "a b\nc d\ne".replace("c d", "cd")),
    ("", ""), ("  \n ", ""), ("<p", ""), ("&", "&"), ("<svg><text>x</text></svg>1 < 2", "1 < 2"),
])
def test_text_of_markup(html, text):
    assert whole(html) == text


def test_deep_and_long_markup():
    assert whole("<div>" * 30_000 + "x") == "x"
    trees = [dom.parse("<div>" * 3000 + "x" + "</div>" * 3000 + "y")]
    x, starts = dom.features(trees)
    assert len(x) == 3001 == starts[-1] and np.isfinite(x).all()
    assert whole("<p>" + "ab " * 500_000).count("ab") == 500_000


def test_choice_is_the_best_consistent_one():
    r = random.Random(3)
    for _ in range(60):
        n = r.randrange(1, 9)
        parent = [0] + [r.randrange(i) for i in range(1, n)]
        scores = np.array([r.uniform(-3, 3) for _ in range(n)])
        best = max(
            sum(s for s, k in zip(scores, keep) if k)
            for keep in itertools.product([False, True], repeat=n)
            if keep[0] and all(keep[parent[v]] or not keep[v] for v in range(1, n)))
        keep = html_text.chosen(scores, parent)
        assert all(keep[parent[v]] or not keep[v] for v in range(1, n))
        assert sum(s for s, k in zip(scores, keep) if k) == pytest.approx(best)


def test_features_of_many_pages_are_those_of_each():
    pages = ["<nav><a href=x>m</a></nav><article class='post main'><p>a b. c</p><p>d</p></article>", "", "<div id=sideBar><p>x</div>"]
    together, starts = dom.features([dom.parse(p) for p in pages])
    for k, page in enumerate(pages):
        alone, _ = dom.features([dom.parse(page)])
        assert np.allclose(together[starts[k] : starts[k + 1]], alone)


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4)).astype(np.float32)
    x[:, 3] = x[:, 3] > 0
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = boosting.fit(x[:2000], y[:2000], np.ones(2000))
    assert ((model.scores(x[2000:]) > 0) == y[2000:]).mean() > 0.97


def article_text(html):
    """The text of the one article, by the template of the given pages."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    lines = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
    return "\n".join(x for x in lines if x)


@pytest.fixture(scope="module")
def given(spark):
    pages = spark.read.parquet(str(SF))
    return pages, html_text.fit(pages)


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_given_pages(spark, given):
    pages, model = given
    want = {r["page_id"]: article_text(r["html"]) for r in pages.collect()}
    got = html_text.extract(pages, model).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) and r["url"] for r in got)


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_layouts_not_trained_on(given):
    pages, model = given
    right = kept = wanted = 0
    for r in pages.limit(30).collect():
        for tree, truth, _ in html_text.lessons(r["html"] + " ")[1:]:
            x, _ = dom.features([tree])
            keep = html_text.chosen(model.scores(x), tree.parent)
            for (size, *_), node in zip(tree.stats, tree.at):
                right += size * (keep[node] and truth[node])
                kept += size * keep[node]
                wanted += size * truth[node]
    assert right / kept > 0.97 and right / wanted > 0.97


HAND = """<!doctype html><html><head><title>T</title><style>x{}</style></head><body>
<div class="cookie-consent"><p>We use small files to make this site better for you.</p><button>Fine</button></div>
<header class="site-header"><div class="logo">The Daily Site</div><form><input><button>Go</button></form></header>
<div class="navbar"><ul><li><a href=/a>Home</a></li><li><a href=/b>World</a></li><li><a href=/c>Sport</a></li></ul></div>
<div id="content"><h1>%s</h1><p>%s</p><p>%s</p><div class="advert">Buy one, get two today only</div><p>%s</p></div>
<div class="sidebar"><h3>Read on</h3><ul><li><a href=/d>Other news of today</a></li><li><a href=/e>More of the same</a></li></ul></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I did not like this one at all.</p></div>
<div class="comment"><b>Bob</b><p>Very good, thank you for it.</p></div></div>
<div class="footer">&copy; 2024 The Daily Site, all rights kept</div></body></html>"""


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_a_page_of_another_kind(given):
    parts = [prose(k, n).capitalize() + "." for k, n in ((1, 6), (2, 60), (3, 45), (4, 80))]
    assert html_text.main_texts([HAND % tuple(parts)], given[1]) == ["\n".join(parts)]


def test_edge_cases(spark):
    a = "<nav><a href=/>m</a></nav><article>" + "".join(f"<p>{prose(k, 30)}.</p>" for k in range(6)) + "</article>"
    rows = [(1, a), (2, None), (3, ""), (None, a), (1, a), (4, "  "), (5, "<script>x</script>"), (6, a.replace("</p>", "") * 40)]
    frame = pages_frame(spark, rows)
    got = html_text.extract(frame, html_text.fit(frame))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = [(r["page_id"], r["text"]) for r in got.collect()]
    want = "\n".join(f"{prose(k, 30)}." for k in range(6))
    assert len(texts) == 8 and texts.count((1, want)) == 2 and (None, want) in texts
    assert all((k, "") in texts for k in (2, 3, 4, 5))
    empty = pages_frame(spark, [])
    assert html_text.fit(empty) is None and html_text.extract(empty, None).count() == 0
    assert html_text.main_texts(["<p>x</p>"], None) == ["x"]
