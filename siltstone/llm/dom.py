"""Element trees of HTML pages, with what a classifier of their nodes needs, for code inside tasks.

Tags may be left open, closed twice or not at all; a page's tree is what a browser would mostly make of it. Formatting
tags are no nodes. Nothing recurses, so nesting may be of any depth.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np

# HTML's own element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never part of a page's text.
SILENT = frozenset("head script style template noscript title textarea select svg math iframe object canvas audio video".split())
FORMAT = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
INLINE = FORMAT | frozenset("button label output picture ruby rb rt rp".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section table ul summary".split())
#: An element of the group on the left ends an open one of it, unless one of those on the right stands between.
_SIBLINGS = {
    **dict.fromkeys(["li"], (frozenset(["li"]), frozenset("ul ol menu dir table".split()))),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), frozenset(["dl", "table"]))),
    **dict.fromkeys(["tr"], (frozenset(["tr"]), frozenset(["table"]))),
    **dict.fromkeys(["td", "th"], (frozenset(["td", "th"]), frozenset(["table", "tr"]))),
    **dict.fromkeys(["tbody", "thead", "tfoot"], (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"]))),
}

#: Features of an element's name.
TAGS = [
    ("nav",), ("header",), ("footer",), ("aside",), ("form", "button", "label", "fieldset", "output", "input", "dialog"),
    ("article",), ("main",), ("section",), ("div",), ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl", "menu"),
    ("li", "dt", "dd"), ("table", "tbody", "thead", "tfoot", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption"), ("ins",),
]
_TAG_BIT = {name: 1 << k for k, names in enumerate(TAGS) for name in names}
#: Words of class, id and role attributes that tell what an element is for.
HINTS = [
    "nav navbar navigation menu submenu breadcrumb breadcrumbs crumbs pagination pager toc skip",
    "header masthead topbar brand logo tagline",
    "footer foot bottom copyright legal colophon contentinfo",
    "sidebar aside side rail widget widgets complementary related recommended recommendations trending popular teaser teasers more",
    "cookie cookies consent gdpr privacy notice alert alertdialog popup modal overlay paywall toast message",
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner commercial",
    "form search login signin signup register subscribe subscription newsletter contact",
    "comment comments reply replies respond discussion disqus thread reader responses",
    "share sharing social follow tags tagcloud buttons tools toolbar",
    "content article post entry story main body text prose page copy",
]
_HINT_BIT = {word: 1 << k for k, words in enumerate(HINTS) for word in words.split()}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_STOPS = re.compile(r"[.!?;,:](?:\s|$)")


class Tree(NamedTuple):
    """Nodes in page order (node 0 is the page), and pieces of text in page order.

    ``end[v]`` is the first node after the subtree of v. Pieces of one ``block`` are parts of one line.
    """

    parent: list[int]
    depth: list[int]
    end: list[int]
    tag: list[int]
    hint: list[int]
    stats: list[tuple[int, int, int, int, int]]
    text: list[str]
    at: list[int]
    block: list[int]
    truth: list[int]


class _Builder(HTMLParser):
    def __init__(self, truth: str | None):
        super().__init__(convert_charrefs=True)
        self.truth_name = truth
        self.parent, self.depth, self.end, self.tag, self.hint, self.truth = [0], [0], [0], [0], [0], [0]
        self.text, self.at, self.block, self.linked = [], [], [], []
        self.names, self.open = [""], [0]
        self.silent = 0
        self.silent_name = ""
        self.line = 0
        self.link = 0  # open elements when the link began

    def _pop_to(self, k: int) -> None:
        """Close the open elements from place ``k`` up."""
        n = len(self.parent)
        for node in self.open[k:]:
            self.end[node] = n
        del self.open[k:], self.names[k:]
        if self.link > k:
            self.link = 0
        self.line += 1

    def handle_starttag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            self.silent += name == self.silent_name
            return
        if name in VOID:
            if name == "hr":
                self.line += 1
            elif name == "br":
                self.handle_data(" ")
            return
        if name in SILENT:
            self.silent, self.silent_name = 1, name
            return
        if name in ("html", "body"):
            return
        inline = name in INLINE
        hint = 0
        for key, value in attrs:
            if value and key in ("class", "id", "role"):
                for word in _WORD.findall(value):
                    hint |= _HINT_BIT.get(word.lower(), 0)
        if name == "a":
            self.link = len(self.open)
        if inline and not (hint & ~(1 << len(HINTS) - 1)) and name in FORMAT:
            return
        if name in ENDS_P:
            for k in range(len(self.names) - 1, 0, -1):
                if self.names[k] == "p":
                    self._pop_to(k)
                    break
                if self.names[k] not in INLINE:
                    break
        elif name in _SIBLINGS:
            same, fence = _SIBLINGS[name]
            for k in range(len(self.names) - 1, 0, -1):
                if self.names[k] in same:
                    self._pop_to(k)
                    break
                if self.names[k] in fence:
                    break
        if not inline:
            self.line += 1
        node = len(self.parent)
        self.parent.append(self.open[-1])
        self.depth.append(len(self.open))
        self.end.append(0)
        self.tag.append(_TAG_BIT.get(name, 0))
        self.hint.append(hint)
        if self.truth_name is not None:
            known = [v for k, v in attrs if k == self.truth_name]
            self.truth.append(int(known[0] or 0) if known else self.truth[self.open[-1]])
        self.open.append(node)
        self.names.append(name)

    def handle_startendtag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(name, attrs)  # a slash ends no HTML element

    def handle_endtag(self, name: str) -> None:
        if self.silent:
            if name == self.silent_name:
                self.silent -= 1
            return
        if name == "a":
            self.link = 0
        inline = name in INLINE
        for k in range(len(self.names) - 1, 0, -1):
            if self.names[k] == name:
                line = self.line
                self._pop_to(k)
                if inline:
                    self.line = line
                return
            if inline and self.names[k] not in INLINE:
                return
        if name in ("p", "body", "html"):
            self.line += 1

    def handle_data(self, data: str) -> None:
        if not self.silent and data:
            self.text.append(data)
            self.at.append(self.open[-1])
            self.block.append(self.line)
            self.linked.append(self.link > 0)


def parse(html: str, truth: str | None = None) -> Tree:
    """The tree of a page; ``truth`` names an attribute that labels an element and what is below it."""
    b = _Builder(truth)
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and re.match("[a-zA-Z/!?]", html[last + 1 : last + 2]):
        html = html[:last]  # a page cut off inside a tag
    b.feed(html)
    b.close()
    b._pop_to(0)
    stats = []
    for text, linked in zip(b.text, b.linked):
        n = len(text) if not text.isspace() else 0
        stats.append((n, n * linked, text.count(" ") + 1 if n else 0, len(_STOPS.findall(text)) if n else 0, 1 if n else 0))
    return Tree(b.parent, b.depth, b.end, b.tag, b.hint, stats, b.text, b.at, b.block, b.truth)


def kept_text(tree: Tree, keep: list[bool]) -> str:
    """Text of the kept nodes: white space becomes one space inside a block, blocks are joined by a line feed."""
    lines, parts, line = [], [], -1
    for text, node, block in zip(tree.text, tree.at, tree.block):
        if not keep[node]:
            continue
        if block != line and parts:
            lines.append(" ".join("".join(parts).split()))
            parts = []
        line = block
        parts.append(text)
    lines.append(" ".join("".join(parts).split()))
    return "\n".join(x for x in lines if x)




def features(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the nodes of all trees, first row of each tree and the end).

    Of a node: depth, place and number among its siblings, how many of them have its name, text of its neighbours, length of
    its text and of its subtree's, words, stops, links, density over elements, shares of parent and page, where it begins in the
    page; then bits of its name and attributes, and of its ancestors'.
    """
    starts = np.concatenate(([0], np.cumsum([len(t.parent) for t in trees]))).astype(np.int64)
    n = int(starts[-1])
    of = np.repeat(np.arange(len(trees)), np.diff(starts))
    base = starts[of]

    def flat(name: str) -> np.ndarray:
        return np.fromiter((x for t in trees for x in getattr(t, name)), np.int64, n)

    parent, end = flat("parent") + base, flat("end") + base
    depth, tag, hint = flat("depth"), flat("tag"), flat("hint")
    pieces = np.concatenate(([0], np.cumsum([len(t.at) for t in trees]))).astype(np.int64)
    at = np.fromiter((x for t in trees for x in t.at), np.int64, int(pieces[-1])) + np.repeat(starts[:-1], np.diff(pieces))
    stats = np.array([s for t in trees for s in t.stats], np.float64).reshape(-1, 5)
    own = np.stack([np.bincount(at, stats[:, k], n) for k in range(5)], 1) if n else np.zeros((0, 5))
    own = np.concatenate([own, (tag == _TAG_BIT["p"]).astype(float)[:, None]], 1)
    sums = np.concatenate((np.zeros((1, 6)), np.cumsum(own, 0)))
    below = sums[end] - sums[np.arange(n)]
    length, links, words, stops, _, paragraphs = below.T
    page = below[starts[of]] if n else below
    before = sums[np.arange(n), 0] - sums[base, 0]
    # Siblings stand in page order when sorted by parent; a page itself is its own parent and has none.
    root = np.arange(n) == base
    group = np.where(root, n + of, parent)
    order = np.argsort(group, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = group[order][1:] != group[order][:-1]
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, n))
    place, siblings = np.empty(n), np.empty(n)
    place[order] = np.arange(n) - np.repeat(first, size)
    siblings[order] = np.repeat(size, size)
    earlier, later = np.zeros(n), np.zeros(n)
    if n > 1:
        same = ~fresh[1:]
        earlier[order[1:]] = length[order[:-1]] * same
        later[order[:-1]] = length[order[1:]] * same
    _, alike, count = np.unique(group * (1 << len(TAGS)) + tag, return_inverse=True, return_counts=True)
    above_tag, above_hint = np.zeros(n, np.int64), np.zeros(n, np.int64)
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[by_depth], np.arange(1, int(depth.max(initial=0)) + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        level = by_depth[a:b]
        up = parent[level]
        above_tag[level] = above_tag[up] | tag[up]
        above_hint[level] = above_hint[up] | hint[up]
    elements = (end - np.arange(n)).astype(float)
    safe = np.maximum(length, 1)
    numbers = np.stack([
        depth, place, siblings - place, siblings, count[alike], np.log1p(earlier), np.log1p(later), np.log1p(own[:, 0]),
        np.log1p(length), np.log1p(words), stops / np.maximum(words, 1), links / safe, np.log1p(length / elements),
        length / np.maximum(length[parent], 1), length / np.maximum(page[:, 0], 1), before / np.maximum(page[:, 0], 1),
        np.log1p(paragraphs), safe / np.maximum(words, 1)], 1)
    bits = [(x[:, None] >> np.arange(k)) & 1 for x, k in (
        (tag, len(TAGS)), (hint, len(HINTS)), (above_tag, len(TAGS)), (above_hint, len(HINTS)))]
    return np.concatenate([numbers, *bits], 1).astype(np.float32), starts
