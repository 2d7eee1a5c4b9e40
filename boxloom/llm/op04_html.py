"""HTML extraction by a tree-structured graphical model.

A page is parsed into a tree of block elements. Each node is content or not; a node's features give its potentials,
and each parent-child edge has a potential over both labels, by the kinds of both. Sum-product message passing,
upward from the leaves and downward from the root, gives each node's marginal probability of being content; the
text of nodes above one half is the main text. All pages of a batch are one forest whose levels are passed
together. The potentials are trained on labelled pages by gradient ascent of the labels' likelihood, whose
expectations are the same messages.

Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by
one space. Inline markup does not break a block; `br` and rules are white space. Scripts, styles, templates, titles and
comments have no text. Unclosed elements end with their parent or the page. Of raw elements without an end tag a script,
style, title or textarea goes on to the page's end; others (noscript, object, iframe, svg, template) are passed through, and
are empty if they close themselves. A `<` that begins no whole tag is text. A page is read in one pass.

Null and empty html: empty text. Pages without content: empty text. Repeated rows are extracted each; other
columns are ignored. An empty table gives an empty result. Extraction is a map over whole pages.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, rows_of

_MARK = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_NAME_ENDS = re.compile(r"[\s/>]")
_RAW = {"script", "style", "title", "noscript", "template", "iframe", "textarea", "svg", "object"}
_TO_THE_END = {"script", "style", "title", "textarea"}
_INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr label".split())
_SPACE = {"br", "hr"}
_VOID = set("area base col embed img input link meta param source track".split())
_CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_TAGS = ["html", "body", "div", "section", "article", "main", "p", "h1", "h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "blockquote pre", "table tbody thead tr td th", "figure figcaption", "header", "footer", "nav", "aside", "form fieldset button select option input", "head"]
_TAG_NUMBER = {name: i for i, names in enumerate(_TAGS) for name in names.split()}
_NEUTRAL = {"html", "body", "div", "section"}
_HINTS = [
    r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner)(?:[^a-z]|$)",
    r"nav|menu|breadcrumb|pagination|pager",
    r"header|masthead|byline",
    r"foot|copyright|imprint",
    r"side|related|widget|recommend",
    r"cookie|consent|notice|alert|popup|modal|newsletter|subscribe|gdpr|warning",
    r"comment|repl(?:y|ies)|disqus|discussion|respond",
    r"share|social|login|search|rating",
    r"article|content|post|entry|story|main|text",
]
_HINT = [re.compile(h) for h in _HINTS]
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SIZES = (1, 25, 80, 300)
N_FEATURES = 1 + len(_TAGS) + 1 + len(_HINTS) + len(_SIZES) + 2
N_KINDS = 9  # of edges, by parent and child: a neutral block, a block that names its role, another


@dataclass
class Tree:
    """Nodes in page order: parent (-1: root), depth, features, kind of the edge above; texts in page order."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


class Tags:
    """The tags of a page, each found in one pass over it whatever the page holds."""

    def __init__(self, page: str):
        self.page = page
        # where a tag ends that meets its k-th `>` or quote outside quotes; -1: in an open quote or never
        self.special = [m.start() for m in re.finditer("[>\"']", page)]
        self.ends = [-1] * (len(self.special) + 1)
        quotes: dict[str, int] = {}
        for k in range(len(self.special) - 1, -1, -1):
            x = page[self.special[k]]
            if x == ">":
                self.ends[k] = self.special[k] + 1
            else:
                self.ends[k] = self.ends[quotes[x] + 1] if x in quotes else -1
                quotes[x] = k
        self.last = page.rfind(">")
        self.name_end = 0
        self.raw_ends: dict[str, tuple[int, int]] = {}

    def _until(self, mark: str, at: int) -> int:
        end = self.page.find(mark, at)
        return len(self.page) if end < 0 else end + len(mark)

    def __iter__(self) -> Iterator[tuple[int, int, str, str, str]]:
        """start, end, "/" or "", name (empty: a comment or declaration), attributes."""
        page, at = self.page, 0
        while m := _MARK.search(page, at):
            start, mark = m.start(), m[0]
            if mark == "<!--":
                end, name, closing, attributes = self._until("-->", m.end()), "", "", ""
            elif mark == "<![CDATA[":
                end, name, closing, attributes = self._until("]]>", m.end()), "", "", ""
            elif start > self.last:
                return
            elif mark[-1] in "!?":
                end, name, closing, attributes = self._until(">", m.end()), "", "", ""
            else:
                if self.name_end < m.end():
                    self.name_end = _NAME_ENDS.search(page, m.end()).start()
                end = self.ends[bisect_left(self.special, self.name_end)]
                if end < 0:
                    at = start + 1
                    continue
                name, closing, attributes = page[m.end() - 1 : self.name_end].lower(), mark[1:-1], page[self.name_end : end - 1]
            at = end
            skip = yield start, end, closing, name, attributes
            if skip is not None:
                at = skip
                yield start, end, "", "", ""

    def raw_end(self, tag: str, at: int) -> int | None:
        """The end of the next end tag of a raw element from `at` on."""
        if tag not in self.raw_ends or 0 <= self.raw_ends[tag][0] < at:
            m = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(self.page, at)
            self.raw_ends[tag] = (m.start(), m.end()) if m else (-1, -1)
        end = self.raw_ends[tag][1]
        return None if end < 0 else end


def parse(page: str) -> Tree:
    tree, stack, links, text = Tree(), [], 0, []
    places: dict[str, list[int]] = {}  # where the stack holds a tag

    def open_node(tag: str, attributes: str) -> None:
        tree.parent.append(stack[-1] if stack else -1)
        tree.depth.append(len(stack))
        tree.tags.append(tag)
        tree.attributes.append(attributes)
        tree.linked.append(0)
        if stack:
            places.setdefault(tag, []).append(len(stack))
        stack.append(len(tree.tags) - 1)

    def close_text() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                tree.texts.append((stack[-1], words))
            text.clear()

    def innermost(names: set[str]) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    def close_to(names: set[str], until: set[str]) -> None:
        """Close the innermost open element of `names`, unless one of `until` is met first."""
        place = innermost(names)
        if place and place >= innermost(until):
            close_text()
            for node in stack[place:]:
                places[tree.tags[node]].pop()
            del stack[place:]

    def add_text(piece: str) -> None:
        if piece:
            text.append(piece)
            if links:
                tree.linked[stack[-1]] += len(piece)

    open_node("html", "")
    tags, at = Tags(page), 0
    found = iter(tags)
    for start, end, closing, tag, attributes in found:
        add_text(page[at:start])
        at = end
        if not tag:
            continue
        if tag in _SPACE:
            text.append(" ")
        elif tag in _RAW:
            if not closing and not (attributes.endswith("/") and tag not in _TO_THE_END):
                stop = tags.raw_end(tag, end)
                if stop is None and tag in _TO_THE_END:
                    stop = len(page)
                if stop is not None:
                    at = stop
                    found.send(stop)
        elif tag in _INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
        elif tag in _VOID:
            continue
        elif tag == "html":
            tree.attributes[0] = tree.attributes[0] or attributes
        elif closing:
            close_text()
            close_to({tag}, set())
        else:
            close_text()
            links = 0
            if tag in _CLOSES_P:
                close_to({"p"}, {"table", "td", "th", "button"})
            if tag in _SIBLINGS:
                close_to(*_SIBLINGS[tag])
            if tag == "body":
                close_to({"head"}, set())
            open_node(tag, attributes)
    add_text(page[at:])
    close_text()
    return tree


def describe(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Features of the nodes and kinds of the edges above them."""
    n = len(tree.tags)
    out, kinds = np.zeros((n, N_FEATURES)), np.zeros(n, int)
    own = [0] * n
    for node, words in tree.texts:
        own[node] += len(words)
    for i, (tag, attributes) in enumerate(zip(tree.tags, tree.attributes, strict=True)):
        row = out[i]
        row[0] = 1
        row[1 + _TAG_NUMBER.get(tag, len(_TAGS))] = 1
        hinted = False
        if attributes:
            names = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(attributes)).lower()
            for j, hint in enumerate(_HINT) if names else ():
                if hint.search(names):
                    row[2 + len(_TAGS) + j] = 1
                    hinted = True
        for j, least in enumerate(_SIZES):
            row[2 + len(_TAGS) + len(_HINTS) + j] = own[i] >= least
        if own[i]:
            share = tree.linked[i] / own[i]
            row[-2], row[-1] = share > 0.3, share > 0.7
        kinds[i] = 1 if hinted or _TAG_NUMBER.get(tag, 0) in range(14, 20) else 0 if tag in _NEUTRAL else 2
    return out, 3 * kinds[np.maximum(tree.parent, 0)] + kinds


@dataclass
class Forest:
    """Trees side by side, with the nodes of each depth."""

    features: np.ndarray
    kinds: np.ndarray
    parent: np.ndarray
    levels: list[np.ndarray]

    @classmethod
    def of(cls, trees: list[Tree]) -> Forest:
        parts = [describe(t) for t in trees]
        starts = np.cumsum([0, *(len(t.tags) for t in trees)])
        parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + s) for t, s in zip(trees, starts, strict=False)])
        depth = np.concatenate([t.depth for t in trees])
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1)))
        return cls(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), parent, levels)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(forest: Forest, unary: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the nodes' labels, and of the label pairs (parent, child) of the edges above them."""
    node = np.c_[np.zeros(len(forest.features)), forest.features @ unary]
    edge, up = edges[forest.kinds], np.zeros_like(node)
    beliefs = node.copy()  # node and all that comes from below
    for level in forest.levels[:0:-1]:
        up[level] = _log_sum(edge[level] + beliefs[level][:, None, :], 2)
        np.add.at(beliefs, forest.parent[level], up[level])
    total = beliefs.copy()  # and from above
    pair = np.zeros((len(node), 2, 2))
    for level in forest.levels[1:]:
        without = total[forest.parent[level]] - up[level]
        joint = without[:, :, None] + edge[level] + beliefs[level][:, None, :]
        total[level] = _log_sum(joint, 1)
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pair[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    total = np.exp(total - total.max(axis=1, keepdims=True))
    return total / total.sum(axis=1, keepdims=True), pair


def train(pages: list[str], steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Potentials from pages whose elements carry keep="1" or keep="0" (children inherit)."""
    trees, labels = [parse(p) for p in pages], []
    for tree in trees:
        own: list[int] = []
        for parent, attributes in zip(tree.parent, tree.attributes, strict=True):
            m = re.search(r'\bkeep="([01])"', attributes)
            own.append(int(m[1]) if m else own[parent] if parent >= 0 else 0)
        labels += own
    forest, y = Forest.of(trees), np.array(labels)
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((N_KINDS, 2, 2))
    np.add.at(seen, (forest.kinds[child], y[forest.parent[child]], y[child]), 1)
    unary, edges = np.zeros(N_FEATURES), np.zeros((N_KINDS, 2, 2))
    speed = [np.zeros_like(unary), np.zeros_like(edges)]
    for _ in range(steps):
        nodes, pairs = marginals(forest, unary, edges)
        expected = np.zeros_like(edges)
        np.add.at(expected, forest.kinds[child], pairs[child])
        for which, (weights, gradient) in enumerate(((unary, forest.features.T @ (y - nodes[:, 1]) - 0.02 * unary), (edges, seen - expected - 0.02 * edges))):
            speed[which] += gradient**2
            weights += 0.5 * gradient / np.sqrt(speed[which] + 1e-9)
    return unary, edges


def extract(pages: list[str | None], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    trees = [parse(p or "") for p in pages]
    if not trees:
        return []
    content = marginals(Forest.of(trees), *model)[0][:, 1] > 0.5
    out, start = [], 0
    for tree in trees:
        out.append(" ".join(words for node, words in tree.texts if content[start + node]))
        start += len(tree.tags)
    return out


def main_text(pages: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    from boxloom.llm.labelled_pages import PAGES

    shared = pages.sparkSession.sparkContext.broadcast(model or train(PAGES))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def scan(batches):
        out, held, size = Sink(schema, 4_000_000), [], 0

        def flush():
            for (page_id, url, _), text in zip(held, extract([h[2] for h in held], shared.value), strict=True):
                out.add(page_id, url, text, len(text), weight=len(text) + 100)
            held.clear()
            return out.take()

        for row in rows_of(batches, "page_id", "url", "html"):
            held.append(row)
            size += len(row[2] or "") + 100
            if size > 1_000_000:
                yield flush()
                size = 0
        yield flush()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(scan, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
