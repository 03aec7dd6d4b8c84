"""Main text of HTML pages: boosted trees over the nodes of a page, decided for the whole tree at once.

Every node (``dom.py``) gets the log-odds that its subtree holds main text, from its name, its attributes' words, its
ancestors', its depth, density, links, and its siblings. A node below a dropped one is dropped, and one above a kept one is kept:
of all such choices the page gets the one of largest summed log-odds, which one pass up and one down the tree finds.

The model learns from a bounded sample of the pages themselves (``SAMPLE`` pages of at most ``LONGEST`` characters). A page
with one ``article`` or ``main`` element says by it what its main text is. As pages of one corpus look alike, each
sampled page is also laid out anew in several ways, from its own paragraphs: with and without telling names, with
menus, headers, footers, sidebars, notices, adverts, forms and comments made of other texts of it.
Pages without such an element teach through the paragraphs they have outside of links.

Defined results: a page without text, an empty and a null page give an empty text of no characters; where the sample has no text no
model is fitted and all text outside of scripts, styles and heads is kept; repeated rows give equal results; columns
other than id, address and page, whatever their names, take no part.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import boosting
from siltstone.llm.dom import HINTS, TAGS, Tree, features, kept_text, parse
from siltstone.llm.textbytes import blocks

SAMPLE = 160
LONGEST = 60_000
LAYOUTS = 6
#: A page as it is counts as so many layouts.
OWN_WEIGHT = 6.0
_BLOCK_BYTES = 1 << 20
_TRUTH = "data-truth"
_MAIN = ("article", "main")
_MAIN_BITS = sum(1 << k for k, names in enumerate(TAGS) if names[0] in _MAIN)
_BOILER_BITS = sum(1 << k for k, names in enumerate(TAGS) if names[0] in ("nav", "footer", "aside", "form"))
_BOILER_HINTS = (1 << len(HINTS) - 1) - 1


def own_truth(tree: Tree) -> list[int] | None:
    """Per node 1 where it stands in the page's one main element; None if the page does not say."""
    n = len(tree.parent)
    outer = [v for v in range(n) if tree.tag[v] & _MAIN_BITS]
    for name in _MAIN[::-1]:
        bit = next(1 << k for k, names in enumerate(TAGS) if names[0] == name)
        found = [v for v in outer if tree.tag[v] & bit]
        if len(found) == 1:
            break
    else:
        return None
    main, out = found[0], [0] * n
    for v in range(main, tree.end[main]):
        inside = v == main or out[tree.parent[v]]
        out[v] = int(inside and not (v != main and (tree.tag[v] & _BOILER_BITS or tree.hint[v] & _BOILER_HINTS)))
    return out


def node_labels(tree: Tree, truth: list[int]) -> np.ndarray:
    """1 for nodes whose subtree holds main text, 0 for others with text, -1 for nodes without any."""
    n = len(tree.parent)
    text, main = np.zeros(n + 1), np.zeros(n + 1)
    for (size, *_), node in zip(tree.stats, tree.at):
        text[node + 1] += size
        main[node + 1] += size * truth[node]
    text, main, end = np.cumsum(text), np.cumsum(main), np.array(tree.end)
    has, holds = text[end] - text[:n], main[end] - main[:n]
    return np.where(has == 0, -1, (holds > 0).astype(int))


def chosen(scores: np.ndarray, parent: list[int]) -> list[bool]:
    """The choice of largest summed score in which no kept node stands below a dropped one."""
    gain = scores.tolist()
    for v in range(len(gain) - 1, 0, -1):
        if gain[v] > 0:
            gain[parent[v]] += gain[v]
    keep = [True] * len(gain)
    for v in range(1, len(gain)):
        keep[v] = keep[parent[v]] and gain[v] > 0
    return keep


# --- Pages laid out anew

_CONTENT = ["content", "article", "post", "entry-content", "story", "main-content", "article-body", "post-content", "text", "page-content"]
_PLAIN = ["c1", "wrap", "row", "col-8", "inner", "box", "grid", "x12", "container", "block", "l-main", "css-1a2b"]
_KINDS = {
    # What a part is: the elements it may be, and words of its attributes.
    "menu": (["nav", "div", "ul", "header"], ["nav", "menu", "navbar", "main-nav", "breadcrumbs", "navigation", "top-menu"]),
    "head": (["header", "div"], ["header", "site-header", "masthead", "branding logo", "topbar"]),
    "foot": (["footer", "div"], ["footer", "site-footer", "copyright", "page-footer", "colophon"]),
    "side": (["aside", "div", "section"], ["sidebar", "side", "widget", "related", "recommended", "right-rail", "trending"]),
    "notice": (["div", "section", "dialog", "p"], ["cookie-notice", "consent", "alert", "notice", "cookie-banner", "popup", "gdpr"]),
    "advert": (["div", "aside", "ins", "p", "section"], ["ad", "ads", "advert", "sponsored", "promo", "advertisement", "ad-slot"]),
    "form": (["form", "div"], ["newsletter", "search-form", "signup", "contact-form", "subscribe", "login"]),
    "comments": (["section", "div", "ol"], ["comments", "comment-list", "discussion", "replies", "responses", "disqus"]),
    "share": (["div", "ul", "p"], ["share", "social", "sharing", "tags", "share-buttons"]),
}


class _Layout:
    """One way of laying out a page, drawn from ``r``."""

    def __init__(self, r: random.Random, main: list[str], other: list[str]):
        self.r, self.main = r, main
        self.words = " ".join(other).split() or ["text"]
        self.named = r.random() < 0.75  # attributes tell what a part is
        self.semantic = r.random() < 0.4  # elements do

    def some(self, low: int, high: int) -> str:
        k, n = self.r.randrange(len(self.words)), self.r.randint(low, high)
        return escape(" ".join((self.words * (1 + (k + n) // len(self.words)))[k : k + n]) or "text")

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.r.randrange(999)}">{self.some(low, high)}</a>'

    def wrap(self, kind: str, inner: str, truth: int = 0) -> str:
        names, words = _KINDS[kind]
        name = names[0] if self.semantic else self.r.choice(names[1:] if self.r.random() < 0.7 else names)
        word = self.r.choice(words if self.named or name in ("div", "p", "section") and self.r.random() < 0.5 else _PLAIN)
        where = self.r.choice(["class", "class", "class", "id"])
        attribute = f' {where}="{word}"' if self.named or self.r.random() < 0.5 else ""
        return f'<{name}{attribute} {_TRUTH}="{truth}">{inner}</{name}>'

    def part(self, kind: str) -> str:
        r = self.r
        if kind == "menu":
            sep = r.choice(["", " | ", " "])
            links = [self.link() for _ in range(r.randint(3, 9))]
            inner = f"<ul>{''.join(f'<li>{x}</li>' for x in links)}</ul>" if r.random() < 0.7 else sep.join(links)
        elif kind == "head":
            title = r.choice(["<h1>%s</h1>", "<div>%s</div>", "<p>%s</p>", "<span>%s</span>"]) % self.some(1, 4)
            inner = title + (f"<p>{self.some(3, 9)}</p>" if r.random() < 0.6 else "") + (self.link() if r.random() < 0.5 else "")
        elif kind == "foot":
            inner = f"&copy; {self.some(2, 12)}" if r.random() < 0.5 else f"<p>&copy; 2024 {self.some(2, 25)}</p>"
            inner += "".join(f" {self.link()}" for _ in range(r.randrange(5)))
        elif kind == "side":
            items = [f"<li>{self.link(2, 9)}</li>" if r.random() < 0.6 else f"<p>{self.some(5, 40)}</p>" for _ in range(r.randint(1, 6))]
            inner = (f"<h3>{self.some(1, 4)}</h3>" if r.random() < 0.7 else "") + "".join(items)
        elif kind == "notice":
            inner = r.choice(["<p>%s</p>", "%s", "<div>%s</div>"]) % self.some(6, 45) + (f"<button>{self.some(1, 2)}</button>" if r.random() < 0.6 else "")
        elif kind == "advert":
            inner = r.choice(["%s", "<p>%s</p>", "<a href='/b'>%s</a>", "<span>%s</span>"]) % self.some(2, 25)
        elif kind == "form":
            inner = f"<label>{self.some(1, 4)}</label><input name=q><p>{self.some(2, 15)}</p><button>{self.some(1, 2)}</button>"
        elif kind == "comments":
            one = r.choice(["<div><b>%s</b><p>%s</p></div>", "<li><p>%s</p><p>%s</p></li>", "<p>%s: %s</p>", '<article class="comment"><h4>%s</h4><p>%s</p></article>'])
            items = [one % (self.some(1, 2), self.some(4, 60)) for _ in range(r.randint(1, 5))]
            inner = (f"<h3>{self.some(1, 3)}</h3>" if r.random() < 0.6 else "") + "".join(items)
        else:
            inner = " ".join(self.link(1, 2) for _ in range(r.randint(2, 6)))
        return self.wrap(kind, inner)

    def paragraph(self, text: str, k: int) -> str:
        r, text = self.r, escape(text, quote=False)
        if r.random() < 0.15:
            words = text.split(" ")
            i = r.randrange(len(words))
            words[i : i + 3] = [f"<a href='/x'>{' '.join(words[i : i + 3])}</a>"]
            text = " ".join(words)
        x = r.random()
        if k and x < 0.06:
            return f"<h2>{text[:60]}</h2>" if "<" not in text else f"<p>{text}</p>"
        if x < 0.1:
            return f"<ul><li>{text}</li><li>{self.some(3, 12)}</li></ul>"
        if x < 0.13:
            return f"<blockquote><p>{text}</p></blockquote>"
        if x < 0.16:
            return f"<table><tr><td>{self.some(1, 3)}</td><td>{text}</td></tr></table>"
        return self.block % text

    def page(self) -> str:
        r = self.r
        self.block = r.choice(["<p>%s</p>", "<p>%s</p>", "<p>%s", "<div>%s</div>", "<p><b>%s<br>"])
        body = [f"<h1>{escape(self.main[0][:60])}</h1>"] if r.random() < 0.75 else []
        if body and r.random() < 0.2:
            body = [f"<header>{body[0]}</header>"]
        for k, text in enumerate(self.main):
            body.append(self.paragraph(text, k))
            if r.random() < 0.06:
                body.append(self.part(r.choice(["advert", "share", "form", "notice", "side"])))
        name = r.choice(["article", "main"]) if self.semantic or r.random() < 0.2 else r.choice(["div", "div", "section", "td"])
        word = r.choice(_CONTENT if r.random() < (0.8 if self.named else 0.2) else _PLAIN)
        if r.random() < 0.4:
            body.append(self.part(r.choice(["share", "comments", "form", "side"])))
        main = f'<{name} class="{word}" {_TRUTH}="1">{"".join(body)}</{name}>'
        if name == "td":
            main = f"<table><tr><td>{self.part('menu')}</td>{main}</tr></table>"
        before = [self.part(k) for k in ("notice", "head", "menu", "advert", "form", "share", "side") if r.random() < 0.45]
        after = [self.part(k) for k in ("comments", "side", "advert", "form", "share", "notice", "menu", "foot") if r.random() < 0.45]
        r.shuffle(before)
        inner = "".join(before) + main + "".join(after)
        for _ in range(r.randrange(4)):
            inner = f'<div class="{r.choice(_PLAIN)}">{inner}</div>'
        return f'<html><head><title>{self.some(2, 8)}</title></head><body {_TRUTH}="0">{inner}</body></html>'


def lessons(html: str) -> list[tuple[Tree, list[int], float]]:
    """Trees with their truth and weight: the page itself if it says what its main text is, and its layouts."""
    tree = parse(html)
    truth = own_truth(tree)
    out = [] if truth is None else [(tree, truth, OWN_WEIGHT)]
    is_p = next(1 << k for k, names in enumerate(TAGS) if names == ("p",))
    marks = truth if truth is not None else [int(bool(t & is_p)) for t in tree.tag]
    main = kept_text(tree, [bool(m) for m in marks]).split("\n")
    other = kept_text(tree, [not m for m in marks]).split("\n")
    main = [x for x in main if x]
    if not main:
        return out
    r = random.Random(zlib.crc32(html.encode()))
    for _ in range(LAYOUTS):
        # Some articles are a few words long.
        words = " ".join(main).split()
        held = [" ".join(words[: r.randint(1, 12)])] if r.random() < 0.2 else main
        fresh = parse(_Layout(r, held, main + other).page(), _TRUTH)
        out.append((fresh, fresh.truth, 1.0))
    return out


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for html in batch.column(0).to_pylist():
            taught = lessons(html)
            if not taught:
                continue
            x, starts = features([t for t, _, _ in taught])
            y = np.concatenate([node_labels(t, truth) for t, truth, _ in taught])
            w = np.repeat([weight for _, _, weight in taught], np.diff(starts))
            used = y >= 0
            made = x[used].astype("<f4"), y[used].astype("<f4"), w[used].astype("<f4")
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in made], ["x", "y", "w"])


def fit(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> boosting.Boosted | None:
    """A model of the nodes of the table's pages, from ``SAMPLE`` of them, chosen by a hash of their id and text."""
    html = F.col(html_column)
    usable = pages.select(html.alias("html"), F.xxhash64(F.col(id_column).cast("string"), html).alias("mark"))
    usable = usable.filter((F.length("html") > 0) & (F.length("html") <= LONGEST))
    sample = usable.orderBy("mark").limit(SAMPLE).select("html").repartition(8)
    rows = sample.mapInArrow(_teach, "x binary, y binary, w binary").collect()
    rows = sorted(tuple(bytes(r[c]) for c in "xyw") for r in rows)  # the order of the sample's rows does not matter
    x, y, w = (np.frombuffer(b"".join(r[k] for r in rows), "<f4") for k in range(3))
    if not len(y) or y.min() == y.max():
        return None
    return boosting.fit(x.reshape(len(y), -1), y.astype(float), w.astype(float))


def main_texts(pages: list[str], model: boosting.Boosted | None) -> list[str]:
    """The main text of each page."""
    trees = [parse(p) for p in pages]
    if model is None:
        return [kept_text(t, [True] * len(t.parent)) for t in trees]
    x, starts = features(trees)
    scores = model.scores(x)
    return [kept_text(t, chosen(scores[a:b], t.parent)) for t, a, b in zip(trees, starts, starts[1:])]


def extract(
    pages: DataFrame, model: boosting.Boosted | None, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, under the names of its own id and address columns."""
    types = dict(pages.dtypes)
    schema = f"`{id_column}` {types[id_column]}, `{url_column}` {types[url_column]}, text string, n_chars bigint"
    rows = pages.select(id_column, url_column, F.col(html_column).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "__html", _BLOCK_BYTES):
            part = b.batch.slice(b.lo, b.hi - b.lo)
            texts = main_texts([h or "" for h in part.column(2).to_pylist()], model)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_column, url_column, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
