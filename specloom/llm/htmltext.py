"""Main text of HTML pages: flat text blocks, classified by a decision tree over their neighbourhood.

A small helper cuts a page into flat blocks. Everything else is column expressions: word count and
link density of a block and of the blocks beside it, the fitted tree as nested CASE, and the join of
the kept blocks. The tree is fitted on the driver from `LABELLED`, a table of a few dozen rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from specloom.llm.batches import text_batches, trimmed

FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links", "zone")

# Elements whose source is no text at all.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
# Elements whose content is no text of the page.
MUTE = {"select", "button", "svg", "math", "object", "canvas", "audio", "video", "template", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label link mark meta meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
# An open paragraph or item ends where one of these begins, so they never stay on the stack of zones.
SHORT = set("p li dt dd tr td th thead tbody tfoot option h1 h2 h3 h4 h5 h6".split())
CONTENT = {"article", "main"}
CLUTTER = {"nav", "footer", "aside", "form", "menu", "dialog", "header"}
# Names in class or id that mark what surrounds an article.
CLUTTER_NAMES = set(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead topbar header cookie cookies consent notice notices alert popup modal overlay newsletter subscribe signup login share sharing social "
    "related recommended comment comments reply replies disqus widget pagination pager copyright legal toolbar search".split()
)
# Inside these an article is no main text either.
STRICT = {"comment", "comments", "reply", "replies", "disqus", "related", "recommended", "widget", "promo", "ad", "ads", "advert", "adverts", "advertisement", "sponsored"}
CONTENT_NAMES = {"article", "post", "entry", "story", "content"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*(?:\"[^\"]*\"|'[^']*')|=|[\"'])*+)>")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_COMMENT_END = re.compile(r"--!?>")


# What class, id and role of an element say.
_STRICT_NAME, _CLUTTER_NAME, _CONTENT_NAME = 1, 2, 4


def _marks(attributes: str) -> int:
    names: set[str] = set()
    for m in _NAMES.finditer(attributes):
        for word in (m[1] or m[2] or m[3] or "").lower().split():
            names.add(word)
            parts = re.split(r"[-_]+", word)
            if parts[0] not in ("has", "with", "no", "without", "is"):
                names.update(parts)
    return _STRICT_NAME * bool(names & STRICT) + _CLUTTER_NAME * bool(names & CLUTTER_NAMES) + _CONTENT_NAME * bool(names & CONTENT_NAMES)


def _zone_of(tag: str, marks: int, most: bool, around: int) -> int:
    """1 inside an article, -1 inside clutter, -2 inside clutter that holds no article, 0 elsewhere. An
    element that holds most of the page is no clutter for its name's sake: it is a wrapper."""
    if around == -2:
        return -2
    if marks & _STRICT_NAME:
        return -2
    if tag in ("nav", "footer", "aside", "menu", "dialog") or (tag == "form" and not most):
        return -2 if tag != "aside" else -1
    if tag in CONTENT:
        return 1
    if tag == "header":
        return around if around == 1 else -1
    if tag not in ("body", "html") and marks & _CLUTTER_NAME and not most:
        return -1
    if around == 0 and marks & _CONTENT_NAME:
        return 1
    return around


class _Elements:
    """Elements that can have a zone, each after the one that holds it; number 0 is the page."""

    def __init__(self) -> None:
        self.above, self.tag, self.marks = [0], [""], [0]
        self.words, self.blocks = [0], [0]

    def open(self, above: int, tag: str, attributes: str) -> int:
        self.above.append(above)
        self.tag.append(tag)
        self.marks.append(_marks(attributes) if attributes else 0)
        self.words.append(0)
        self.blocks.append(0)
        return len(self.tag) - 1

    def zones(self) -> list[int]:
        words, blocks = self.words, self.blocks
        for e in range(len(words) - 1, 0, -1):
            words[self.above[e]] += words[e]
            blocks[self.above[e]] += blocks[e]
        out = [0] * len(words)
        for e in range(1, len(words)):
            most = blocks[e] > 1 and 2 * words[e] > words[0]
            out[e] = _zone_of(self.tag[e], self.marks[e], most, out[self.above[e]])
        return out


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """Flat blocks of a page as (text, words, words inside links, zone), in page order. Character
    references are decoded, white space is one blank, empty blocks are left out; a tag that the end of
    the page cuts is dropped."""
    out: list[tuple[str, int, int, int]] = []
    elements = _Elements()
    stack: list[int] = []
    opened: Counter[str] = Counter()
    inside, links, mute = 0, 0, ""
    parts: list[tuple[str, bool]] = []

    def close() -> None:
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            n = text.count(" ") + 1
            linked = len(" ".join(t for t, in_link in parts if in_link).split())
            out.append((text, n, min(n, linked), inside))
            elements.words[inside] += n
            elements.blocks[inside] += 1
        parts.clear()

    at, size = 0, len(page)
    while at < size:
        to = page.find("<", at)
        if to < 0:
            to = size
        if to > at and not mute:
            parts.append((html.unescape(page[at:to]), links > 0))
        if to >= size:
            break
        after = page[to + 1 : to + 2]
        if page.startswith("<!--", to):
            if page.startswith((">", "->"), to + 4):
                at = page.index(">", to) + 1
                continue
            end = _COMMENT_END.search(page, to + 4)
            at = end.end() if end else size
            continue
        slash_name = after == "/" and page[to + 2 : to + 3].isascii() and page[to + 2 : to + 3].isalpha()
        if after in ("!", "?") or (after == "/" and not slash_name):
            end_at = page.find(">", to)
            at = end_at + 1 if end_at >= 0 else size
            continue
        if not slash_name and not (after.isascii() and after.isalpha()):
            if not mute:
                parts.append(("<", links > 0))
            at = to + 1
            continue
        m = _TAG.match(page, to)
        if not m:
            break
        at, closing, tag, attributes = m.end(), bool(m[1]), m[2].lower(), m[3]
        if mute:
            if closing and tag == mute:
                mute = ""
            continue
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in MUTE and not closing and not attributes.endswith("/"):
            mute = tag
            continue
        if tag == "br":
            parts.append((" ", False))
        if tag == "a":
            links = 0 if closing else 1
        if tag in INLINE or tag in VOID:
            if tag == "hr":
                close()
            continue
        close()
        if tag not in SHORT:
            if not closing:
                links = 0
                stack.append(inside)
                opened[tag] += 1
                inside = elements.open(inside, tag, attributes)
            elif opened[tag]:
                links = 0
                while True:
                    top = elements.tag[inside]
                    opened[top] -= 1
                    inside = stack.pop()
                    if top == tag:
                        break
    close()
    zones = elements.zones()
    return [(text, n, linked, max(zones[e], -1)) for text, n, linked, e in out]


# Blocks labelled by hand (1: main text): words, link density; the same of the block before and of
# the block after, 0 words where there is none; zone (1 article, -1 clutter, 0 neither).
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, -1, 0), (1, 1.0, 1, 1.0, 1, 1.0, -1, 0), (1, 1.0, 1, 1.0, 5, 0.0, -1, 0),
    (2, 1.0, 2, 1.0, 2, 1.0, -1, 0), (5, 0.0, 1, 1.0, 9, 0.0, -1, 0), (6, 0.0, 1, 1.0, 12, 0.0, -1, 0),
    (10, 0.0, 1, 1.0, 9, 0.0, -1, 0), (12, 0.0, 80, 0.0, 0, 0.0, -1, 0), (25, 0.0, 60, 0.0, 0, 0.0, -1, 0),
    (18, 0.1, 4, 0.0, 0, 0.0, -1, 0), (40, 0.0, 90, 0.0, 0, 0.0, -1, 0), (70, 0.0, 30, 0.0, 45, 0.0, -1, 0),
    (45, 0.0, 70, 0.0, 6, 0.0, -1, 0), (3, 0.0, 45, 0.0, 0, 0.0, -1, 0), (4, 0.5, 3, 0.0, 3, 0.0, -1, 0),
    (120, 0.0, 0, 0.0, 8, 0.0, -1, 0), (14, 0.9, 14, 0.9, 14, 0.9, -1, 0), (30, 0.0, 1, 1.0, 11, 0.0, -1, 0),
    (9, 0.0, 5, 0.0, 60, 0.0, 1, 1), (8, 0.0, 10, 0.0, 1, 0.0, 1, 1), (11, 0.0, 6, 0.0, 0, 0.0, 1, 1),
    (1, 0.0, 60, 0.0, 1, 0.0, 1, 1), (1, 0.0, 1, 0.0, 40, 0.0, 1, 1), (1, 0.0, 1, 0.0, 12, 0.0, 1, 1),
    (2, 0.0, 30, 0.0, 25, 0.0, 1, 1), (60, 0.0, 9, 0.0, 80, 0.0, 1, 1), (80, 0.05, 60, 0.0, 90, 0.0, 1, 1),
    (200, 0.0, 80, 0.0, 25, 0.0, 1, 1), (35, 0.2, 40, 0.0, 50, 0.1, 1, 1), (20, 0.4, 60, 0.0, 70, 0.0, 1, 1),
    (12, 0.6, 50, 0.0, 40, 0.0, 1, 1), (150, 0.0, 9, 0.0, 0, 0.0, 1, 1), (7, 0.0, 150, 0.0, 22, 0.0, 1, 1),
    (3, 0.0, 0, 0.0, 0, 0.0, 1, 1), (400, 0.0, 1, 1.0, 16, 0.0, 1, 1), (5, 0.0, 1, 1.0, 2, 0.0, 1, 1),
    (4, 1.0, 70, 0.0, 4, 1.0, 1, 1), (3, 1.0, 4, 1.0, 3, 1.0, 1, 1), (6, 0.95, 3, 1.0, 0, 0.0, 1, 1),
    (40, 0.0, 8, 0.0, 60, 0.0, 0, 1), (60, 0.1, 40, 0.0, 30, 0.0, 0, 1), (25, 0.0, 60, 0.0, 45, 0.0, 0, 1),
    (90, 0.0, 0, 0.0, 0, 0.0, 0, 1), (50, 0.2, 2, 1.0, 40, 0.0, 0, 1), (9, 0.0, 3, 1.0, 50, 0.0, 0, 1),
    (8, 0.0, 45, 0.0, 55, 0.0, 0, 1), (5, 0.0, 60, 0.0, 70, 0.0, 0, 1), (30, 0.0, 55, 0.0, 4, 1.0, 0, 1),
    (18, 0.1, 40, 0.0, 35, 0.0, 0, 1), (120, 0.0, 5, 0.0, 3, 1.0, 0, 1), (22, 0.0, 9, 0.0, 40, 0.0, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0), (1, 1.0, 0, 0.0, 1, 1.0, 0, 0), (4, 0.0, 2, 1.0, 2, 1.0, 0, 0),
    (6, 0.0, 1, 1.0, 1, 1.0, 0, 0), (9, 0.9, 30, 0.0, 8, 0.9, 0, 0), (5, 0.0, 4, 0.0, 3, 0.0, 0, 0),
    (12, 0.8, 12, 0.8, 10, 0.7, 0, 0), (30, 0.7, 3, 1.0, 20, 0.8, 0, 0), (3, 0.0, 50, 0.0, 0, 0.0, 0, 0),
    (7, 0.0, 2, 1.0, 0, 0.0, 0, 0), (4, 0.0, 6, 0.0, 2, 1.0, 0, 0), (10, 0.5, 8, 0.6, 0, 0.0, 0, 0),
    (5, 1.0, 0, 0.0, 80, 0.0, -1, 0), (15, 0.0, 2, 1.0, 90, 0.0, -1, 0), (60, 0.0, 1, 1.0, 70, 0.0, -1, 0), (30, 0.0, 30, 0.0, 35, 0.0, -1, 0),
    (22, 0.1, 40, 0.0, 45, 0.0, -1, 0), (2, 0.0, 60, 0.0, 50, 0.0, -1, 0), (8, 0.2, 0, 0.0, 25, 0.0, -1, 0), (90, 0.0, 90, 0.0, 90, 0.0, -1, 0),
    (3, 1.0, 2, 1.0, 60, 0.0, 0, 0), (2, 1.0, 40, 0.0, 50, 0.0, 0, 1), (8, 0.9, 60, 0.0, 70, 0.0, 0, 1), (4, 1.0, 35, 0.0, 80, 0.0, 0, 1), (16, 0.8, 3, 1.0, 40, 0.0, 0, 0),
    (3, 0.0, 2, 1.0, 4, 0.0, 0, 0), (6, 0.0, 0, 0.0, 0, 0.0, 0, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 1), (11, 0.0, 0, 0.0, 0, 0.0, 0, 1), (3, 1.0, 0, 0.0, 0, 0.0, 0, 0), (4, 0.0, 80, 0.0, 3, 0.0, 0, 0), (35, 0.0, 0, 0.0, 0, 0.0, 0, 1),
    (5, 1.0, 60, 0.0, 45, 0.0, 1, 1), (3, 1.0, 5, 1.0, 50, 0.0, 1, 1), (9, 0.7, 40, 0.0, 60, 0.0, 1, 1), (25, 0.8, 10, 0.0, 6, 0.0, 1, 1),
    (6, 0.3, 2, 1.0, 3, 0.0, 1, 1), (1, 0.0, 1, 0.0, 1, 0.0, 1, 1), (2, 0.0, 0, 0.0, 1, 1.0, 1, 1), (30, 0.0, 4, 1.0, 2, 1.0, 1, 1),
]


@dataclass
class Node:
    keep: bool
    feature: int = -1
    bound: float = 0.0
    low: Node | None = None
    high: Node | None = None


def _impurity(y: np.ndarray) -> float:
    p = y.mean() if y.size else 0.0
    return float(y.size * p * (1 - p))


def fit(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node:
    """Binary decision tree by Gini impurity; ties go to the first feature and the smaller bound."""
    node = Node(bool(y.mean() >= 0.5))
    if depth == 0 or _impurity(y) == 0:
        return node
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for bound in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= bound
            score = _impurity(y[low]) + _impurity(y[~low])
            if best is None or score < best[0] - 1e-12:
                best = (score, f, float(bound))
    if best is None or best[0] >= _impurity(y) - 1e-12:
        return node
    _, node.feature, node.bound = best
    low = x[:, node.feature] <= node.bound
    node.low, node.high = fit(x[low], y[low], depth - 1), fit(x[~low], y[~low], depth - 1)
    return node


def fitted(labelled=LABELLED) -> Node:
    rows = np.array(labelled, dtype=float)
    return fit(rows[:, :-1], rows[:, -1])


def as_column(node: Node, features: dict[str, Column]) -> Column:
    """The tree as nested CASE over feature columns."""
    if node.low is None or node.high is None:
        return F.lit(node.keep)
    return F.when(features[FEATURES[node.feature]] <= node.bound, as_column(node.low, features)).otherwise(as_column(node.high, features))


_BLOCK = "array<struct<text:string,words:int,linked:int,zone:int>>"
_FIELDS = [("text", pa.string()), ("words", pa.int32()), ("linked", pa.int32()), ("zone", pa.int32())]


def block_column(page: Column) -> Column:
    """Flat blocks of an HTML column; null and empty pages have none."""
    text_batches()

    @F.arrow_udf(_BLOCK)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in trimmed(batches):
            found = [blocks(p) if p else [] for p in batch.to_pylist()]
            columns = list(zip(*(b for page in found for b in page), strict=True)) or [()] * len(_FIELDS)
            values = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], [n for n, _ in _FIELDS])
            offsets = np.append(0, np.cumsum([len(page) for page in found])).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), values)

    return cut(page)


def main_blocks(cut: Column, tree: Node | None = None) -> Column:
    """The blocks that the tree keeps, of a column selected from `block_column` before."""
    tree = tree or fitted()

    def at(i: Column) -> tuple[Column, Column]:
        b = F.get(cut, i)
        words = F.coalesce(b["words"], F.lit(0)).cast("double")
        return words, F.coalesce(b["linked"] / b["words"], F.lit(0.0))

    def judged(b: Column, i: Column) -> Column:
        before, after = at(i - 1), at(i + 1)
        values = (b["words"].cast("double"), b["linked"] / b["words"], *before, *after, b["zone"].cast("double"))
        return as_column(tree, dict(zip(FEATURES, values, strict=True)))

    return F.filter(cut, judged)


def main_text(cut: Column, tree: Node | None = None) -> Column:
    """Text of the kept blocks, joined by one blank; empty if none is kept."""
    return F.array_join(F.transform(main_blocks(cut, tree), lambda b: b["text"]), " ")
