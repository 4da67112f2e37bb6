"""Operator 2: main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements and runs of text (:func:`parse`;
unclosed and misplaced tags are tolerated; scripts, styles, the head and
comments of the markup are left out).  Every node has a hidden state: part of the
main text or not.  A node's potential is a sum of weights of its features (tag,
class and id words, length, link density, punctuation); each edge has a
potential table by the child's kind and the parent's.  Sum-product messages run
upward and then downward, level by level for all pages of a batch at once, and
give each node's marginal exactly; runs of text at 0.5 or more are kept.

Weights are trained by maximum likelihood (the same messages give the expected
counts) on the labelled pages of :mod:`sameitem.llm.labelled_pages`.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one line feed in page order.  Inline
elements add nothing; ``br`` is white space.

Tags are read by one pass over the page: a quote opens a value only after ``=``, a
value whose quote never closes is a plain one, and ``<!-->`` is an empty comment.
After a tag that the page's end cuts off, the rest is text without its tags.

Defined cases: null and empty html, and pages without main text, give the empty
string; text outside any element is a block of its own; repeated pages are
extracted alike; an empty table gives no rows; columns other than ``page_id``,
``url`` and ``html`` are not read.  Pages are independent rows: no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sameitem.llm.common import batches, prepared, table
from sameitem.llm.labelled_pages import labelled_pages

FEATURES = 1 << 14
TRAIN_PAGES = 600
ITERATIONS = 120

# Fixed values of HTML: elements without content, whose text is not shown, and within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style head noscript template svg iframe object audio video canvas select textarea title "
                   "annotation annotation-xml mphantom".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
                    "strike strong sub sup time tt u var nobr ruby rb rt rp "
                    "math maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mprescripts mroot mrow "
                    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics").split())
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                      "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul").split())
# An opening tag of the left closes an open element of the right, up to the boundary.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
           "option": ({"option"}, {"select"})}

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>"
    r"|(?P<text>[^<]+|<)", re.S)
_CLOSERS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in HIDDEN}
_NAMED = re.compile(r"""\b(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_BODY = re.compile(r"<body", re.I)
_CUT_OFF = re.compile(r"/?[a-zA-Z]")
_ANY_TAG = re.compile(r"<[^<>]*>")
_PART = re.compile(r"[a-z]+", re.I)


@dataclass
class Tree:
    """Nodes in page order (a parent before its children)."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    names: list[tuple] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters inside links
    label: list[int] = field(default_factory=list)   # data-y of the element, or -1

    def add(self, tag: str, parent: int, names: tuple = (), text: str | None = None, linked: int = 0, label: int = -1) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.tag) - 1


@lru_cache(maxsize=1 << 14)
def _attributes(raw: str) -> tuple[tuple, int]:
    names, label = [], -1
    for key, value in _NAMED.findall(raw):
        value = value.strip("\"'")
        if key.lower() == "data-y":
            label = int(value) if value in ("0", "1") else -1
        else:
            names += [x.lower() for x in _PART.findall(value)]
    return tuple(dict.fromkeys(names)), label


def parse(html: str) -> Tree:
    """Tree of block elements and text runs of a page; node 0 is the root."""
    tree = Tree()
    tree.add("#root", -1)
    stack, run, links, linked = [0], [], 0, 0

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                tree.add("#text", stack[-1], text=text, linked=min(linked, len(text)))
            run, linked = [], 0

    at, end = 0, len(html)
    unclosed: set[str] = set()  # hidden elements that no closing tag follows any more
    match = _TOKEN.match
    while at < end:
        m = match(html, at)
        at = m.end()
        text = m.group("text")
        if text is not None:
            if text == "<" and _CUT_OFF.match(html, at):
                text, at = text + _ANY_TAG.sub(" ", html[at:]), end
            shown = unescape(text) if "&" in text else text
            run.append(shown)
            if links:
                linked += len(shown.strip())
            continue
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if m.group("end"):
            if tag == "a":
                links = 0
            elif tag == "br":
                run.append(" ")
            elif tag not in INLINE and tag in (open_tags := [tree.tag[i] for i in stack]):
                flush()
                del stack[len(open_tags) - 1 - open_tags[::-1].index(tag):]
            continue
        if tag in INLINE:
            links = 1 if tag == "a" else links
            if tag == "mtd":  # cells of a matrix are apart
                run.append(" ")
            continue
        if tag in VOID:
            if tag == "br":
                run.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in HIDDEN:
            if not m.group("attrs").rstrip().endswith("/"):
                seen = tag in unclosed
                closer = None if seen else _CLOSERS[tag].search(html, at)
                if closer is None:
                    unclosed.add(tag)
                if closer:
                    at = closer.end()
                elif tag == "head":  # an unclosed head ends where the body starts
                    body = None if seen else _BODY.search(html, at)
                    at = body.start() if body else at
                elif tag in ("script", "style"):
                    at = end
            run.append(" ")
            continue
        flush()
        if tag in CLOSES_P and tree.tag[stack[-1]] == "p":
            stack.pop()
        if tag in IMPLIED:
            closes, edge = IMPLIED[tag]
            for k in range(len(stack) - 1, 0, -1):
                t = tree.tag[stack[k]]
                if t in edge:
                    break
                if t in closes:
                    del stack[k:]
                    break
        if tag in ("html", "body") and tag in [tree.tag[i] for i in stack]:
            continue
        names, label = _attributes(m.group("attrs"))
        node = tree.add(tag, stack[-1], names, label=label)
        if not m.group("attrs").rstrip().endswith("/"):
            stack.append(node)
            links = 0 if tag == "p" else links
    flush()
    return tree


# -- features ------------------------------------------------------------------
# Kinds of nodes, which choose the edge's potential table.
KINDS = {"#text": 0, "p": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "ul": 3, "ol": 3, "li": 3, "dl": 3, "table": 4,
         "tr": 4, "td": 4, "th": 4, "tbody": 4, "article": 5, "main": 5, "nav": 6, "aside": 6, "footer": 6, "header": 6, "form": 6,
         "div": 7, "section": 7}
OTHER, N_KINDS = 8, 9


@lru_cache(maxsize=1 << 16)
def feature(name: str) -> int:
    return crc32(name.encode()) % FEATURES


def _level(n: int) -> int:
    return min(6, max(n, 0).bit_length())


def features(tree: Tree) -> list[list[int]]:
    """Numbers of each node's features."""
    n = len(tree.tag)
    chars, linked, sentences = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        text = tree.text[i]
        if text is not None:
            chars[i], linked[i] = len(text), tree.linked[i]
            sentences[i] = text.count(". ") + text.count("? ") + (text[-1] in ".?!")
        if i:
            p = tree.parent[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            sentences[p] += sentences[i]
    out = []
    for i in range(n):
        tag, p = tree.tag[i], tree.parent[i]
        density = (4 * linked[i]) // chars[i] if chars[i] else 5
        own = [feature("tag " + tag), feature(f"size {tag == '#text'} {_level(chars[i] // 8)}"),
               feature(f"links {tag == '#text'} {density}"), feature(f"tag links {tag} {density}"),
               feature(f"sentences {tag == '#text'} {min(sentences[i], 2)}")]
        own += [feature("name " + x) for x in tree.names[i]]
        if p >= 0:
            own.append(feature(f"under {tree.tag[p]} {tag}"))
        if tag == "#text":
            text = tree.text[i]
            if "©" in text:
                own.append(feature("copyright"))
            if text.endswith("."):
                own.append(feature(f"ends {density}"))
        out.append(own)
    return out


@dataclass
class Forest:
    """Trees of several pages side by side: one array a property."""

    page: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    first: np.ndarray  # of each node's features
    levels: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, trees: list[Tree]) -> Forest:
        page, parent, kind, depth, flat, first = [], [], [], [], [], []
        for k, tree in enumerate(trees):
            base = len(parent)
            for i, own in enumerate(features(tree)):
                p = tree.parent[i]
                page.append(k)
                parent.append(base + p if p >= 0 else -1)
                kind.append(KINDS.get(tree.tag[i], OTHER))
                depth.append(depth[base + p] + 1 if p >= 0 else 0)
                first.append(len(flat))
                flat += own
        arrays = [np.array(x, np.int64) for x in (page, parent, kind, depth, flat, first)]
        out = cls(*arrays)
        order = np.argsort(out.depth, kind="stable")
        edges = np.searchsorted(out.depth[order], np.arange(int(out.depth.max()) + 2 if len(order) else 1))
        out.levels = [order[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        return out


class TreeModel:
    """Node weights, and a 2 x 2 table for each kind of child and of parent."""

    def __init__(self) -> None:
        self.weight = np.zeros(FEATURES)
        self.edge = np.zeros((N_KINDS, N_KINDS, 2, 2))  # child kind, parent kind, parent state, child state

    def marginals(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """P(main text) of each node, and of each edge the joint P(parent, child), by sum-product."""
        n = len(forest.parent)
        unary = np.zeros((n, 2))
        if n:
            unary[:, 1] = np.add.reduceat(self.weight[forest.feature], forest.first)
        up, message = unary.copy(), np.zeros((n, 2))
        parent_kind = forest.kind[np.maximum(forest.parent, 0)]
        for level in forest.levels[:0:-1]:  # upward: children before parents
            table_ = self.edge[forest.kind[level], parent_kind[level]]
            m = np.logaddexp.reduce(table_ + up[level][:, None, :], axis=2)
            message[level] = m
            np.add.at(up, forest.parent[level], m)
        belief, joint = up.copy(), np.zeros((n, 2, 2))
        for level in forest.levels[1:]:  # downward
            p = forest.parent[level]
            table_ = self.edge[forest.kind[level], parent_kind[level]]
            cavity = belief[p] - message[level]
            both = cavity[:, :, None] + table_ + up[level][:, None, :]
            norm = np.logaddexp.reduce(both.reshape(-1, 4), axis=1)
            joint[level] = np.exp(both - norm[:, None, None])
            belief[level] = np.logaddexp.reduce(cavity[:, :, None] + table_, axis=1) + up[level]
        p1 = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        return p1, joint

    def train(self, forest: Forest, label: np.ndarray, iterations: int = ITERATIONS, rate: float = 0.1, decay: float = 1e-4) -> TreeModel:
        """Maximum likelihood by Adam on the exact gradient: what is seen less what is expected."""
        child = np.flatnonzero(forest.parent >= 0)
        p = forest.parent[child]
        where = (forest.kind[child], forest.kind[p])
        seen = np.zeros_like(self.edge)
        np.add.at(seen, (*where, label[p], label[child]), 1)
        pages = max(1, int(forest.page.max()) + 1)
        state = [np.zeros_like(x) for x in (self.weight, self.weight, self.edge, self.edge)]
        count = np.diff(np.append(forest.first, len(forest.feature)))
        for t in range(1, iterations + 1):
            p1, joint = self.marginals(forest)
            g_w = np.bincount(forest.feature, np.repeat(label - p1, count), FEATURES) / pages - decay * self.weight
            expected = np.zeros_like(self.edge)
            np.add.at(expected, where, joint[child])
            g_e = (seen - expected) / pages - decay * self.edge
            for x, g, m, v in ((self.weight, g_w, *state[:2]), (self.edge, g_e, *state[2:])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        return self


def labels_of(tree: Tree) -> np.ndarray:
    """State of every node of a labelled page: main text, or an element with some inside."""
    n = len(tree.tag)
    out = np.zeros(n, np.int64)
    for i in range(n):
        if tree.text[i] is not None:
            out[i] = int(tree.label[tree.parent[i]] == 1)
    for i in range(n - 1, 0, -1):
        if out[i]:
            out[tree.parent[i]] = 1
    return out


@lru_cache(maxsize=1)
def trained(pages: int = TRAIN_PAGES) -> TreeModel:
    trees = [parse(html) for html, _ in labelled_pages(pages)]
    return TreeModel().train(Forest.of(trees), np.concatenate([labels_of(t) for t in trees]))


def extract_texts(model: TreeModel, pages: list[str | None]) -> list[str]:
    """Main text of each page."""
    trees = [parse(html or "") for html in pages]
    forest = Forest.of(trees)
    keep = model.marginals(forest)[0] >= 0.5
    out, at = [], 0
    for tree in trees:
        out.append("\n".join(text for i, text in enumerate(tree.text) if text is not None and keep[at + i]))
        at += len(tree.tag)
    return out


def main_text(spark: SparkSession, pages: DataFrame, keep: list[str], model: TreeModel | None = None) -> DataFrame:
    """``keep`` columns plus ``text`` and ``n_chars`` (code points) of every page's whole ``html``."""
    shared = prepared(spark).sparkContext.broadcast(model or trained())
    picked = pages.select(*keep, F.col("html").alias("_html"))
    schema = picked.drop("_html").withColumns({"text": F.lit("").cast("string"), "n_chars": F.lit(0).cast("long")}).schema

    def run(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(records, 256):
            texts = extract_texts(shared.value, batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"])

    return picked.mapInArrow(run, schema)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return main_text(spark, pages, ["page_id", "url"])
