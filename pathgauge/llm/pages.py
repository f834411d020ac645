"""Main text of web pages: boosted trees over nodes of the page, decoded down the tree."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.boosting import Trees, boost
from pathgauge.llm.common import chunks, hashed_sample

#: At most so many pages train the trees, of no more than so many characters each.
SAMPLE_PAGES = 400
SAMPLE_CHARS = 100_000
DEPTH = 3
#: Characters of prose that show an article on a page that has no element made for one.
SHOWN = 200

_names = lambda text: frozenset(text.split())
_BLOCK = _names(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section select summary table tbody td tfoot th thead tr ul"
    " template object noscript audio video canvas"
)
_VOID = _names("area base br col embed hr img input link meta param source track wbr")
#: Elements whose content is no text of the page, and is skipped up to their end tag.
_RAW = _names("script style title textarea iframe noembed noframes xmp")
#: Elements without text of the page; a block element inside ends them, as in HTML.
_DRAWN = _names("svg math")
#: What stands in for an element that can't be shown; its nodes are judged like any other.
_INSTEAD = _names("template object noscript audio video canvas")
_HEADINGS = _names("h1 h2 h3 h4 h5 h6")
_CLOSES_P = _BLOCK - _names("button caption body dd dt html legend option optgroup select td th tr tbody thead tfoot li summary") - _INSTEAD
#: A start tag ends an open element of these names, up to the nearest of those.
_ENDS = {
    "li": (_names("li"), _names("ul ol menu dir")),
    "dt": (_names("dt dd"), _names("dl")),
    "dd": (_names("dt dd"), _names("dl")),
    "option": (_names("option"), _names("select")),
    "tr": (_names("tr td th"), _names("table")),
    "td": (_names("td th"), _names("tr table")),
    "th": (_names("td th"), _names("tr table")),
    "tbody": (_names("tbody thead tfoot tr td th"), _names("table")),
    "tfoot": (_names("tbody thead tfoot tr td th"), _names("table")),
}
_TAKES_NO_P = _INSTEAD | _names("table td th button caption")  # an open p outside of these isn't ended from inside

_CONTENT_TAGS = _names("article main")
_OTHER_TAGS = _names("nav footer aside form menu button select dialog fieldset header search template audio video canvas")
_ROLES = {"navigation": -1, "banner": -1, "contentinfo": -1, "complementary": -1, "search": -1, "form": -1, "dialog": -1, "alert": -1, "main": 1, "article": 1}

# A quote opens a value only right after "=", and only if it is closed; else it is part of a name.
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+)>")
_OPENING = re.compile(r"<(?=[A-Za-z!?/])")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")
#: Bits that the words of class and id are hashed to.
_HASHED = 16


@dataclass
class Nodes:
    """Block elements of many pages as parallel lists; node 0 of each page stands for the whole page."""

    page: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    #: 1 an element made for the article, -1 one made for something else, 0 neither; by element name or role.
    sign: list[int] = field(default_factory=list)
    kind: list[int] = field(default_factory=list)  # 1 heading, 2 paragraph, 3 list or table part, 4 container, 0 else
    hashed: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    inline: list[int] = field(default_factory=list)
    #: Blocks of text in page order: the node they belong to, and the text.
    owner: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)

    def add(self, page: int, parent: int, depth: int, name: str, attributes: str) -> int:
        sign, hashed = (name in _CONTENT_TAGS) - (name in _OTHER_TAGS), 0
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                value = (m[2] or m[3] or m[4] or "").lower()
                if m[1].lower() == "role":
                    sign = _ROLES.get(value, sign)
                    continue
                for token in re.split(r"[\s_-]+", value):
                    hashed |= 1 << zlib.crc32(token.encode()) % _HASHED if token else 0
        self.page.append(page)
        self.parent.append(parent)
        self.depth.append(depth)
        self.sign.append(sign)
        kind = 1 if name in _HEADINGS else 2 if name in ("p", "blockquote", "pre") else 3 if name in _ENDS else 4 if name in ("div", "section", "td") else 0
        self.kind.append(kind)
        self.hashed.append(hashed)
        for column in (self.chars, self.linked, self.words, self.marks, self.inline):
            column.append(0)
        return len(self.page) - 1


def parse(nodes: Nodes, page: int, html: str) -> None:
    """Add a page's block elements and blocks of text.

    Open elements are ended as HTML ends them: a paragraph by the next block, a list
    or table part by the next of its kind, anything by an end tag further out. A
    tag that never ends is dropped with what follows.
    """
    root = nodes.add(page, -1, 0, "#page", "")
    stack: list[tuple[str, int]] = [("#page", root)]  # name and block node
    opened: dict[str, int] = {}
    parts: list[str] = []
    links, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                node = stack[-1][1]
                nodes.owner.append(node)
                nodes.text.append(text)
                nodes.chars[node] += len(text)
                nodes.linked[node] += min(linked, len(text))
                nodes.words[node] += text.count(" ") + 1
                nodes.marks[node] += len(_PUNCTUATION.findall(text))
        linked = 0

    def end(keep: int) -> None:
        """End all open elements from place ``keep`` on."""
        nonlocal links
        if any(name in _BLOCK for name, _ in stack[keep:]):
            flush()
        for name, _ in stack[keep:]:
            opened[name] -= 1
            links -= name == "a"
        del stack[keep:]

    def last_open(names: frozenset[str], stop: frozenset[str]) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in stop:
                return -1
        return -1

    at, size = 0, len(html)
    while at < size:
        m = _OPENING.search(html, at)
        stop = m.start() if m else size
        if stop > at:
            piece = html[at:stop]
            if "&" in piece:
                piece = unescape(piece)
            if not (opened.get("svg") or opened.get("math")):
                parts.append(piece)
                if links:
                    linked += len(piece.strip())
        if not m:
            break
        at = stop
        if html.startswith("<!--", at):
            close = html.find("-->", at + 4)
            at = size if close < 0 else close + 3
            continue
        if html[at + 1] in "!?":
            close = html.find(">", at)
            at = size if close < 0 else close + 1
            continue
        m = _TAG.match(html, at)
        if not m:
            if html[at + 1] == "/":
                close = html.find(">", at)  # no name: a comment
                at = size if close < 0 else close + 1
                continue
            break
        at = m.end()
        name = m[2].lower()
        if m[1]:
            if opened.get(name):
                inline = name not in _BLOCK and name not in _DRAWN
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        end(k)
                        break
                    if inline and stack[k][0] in _BLOCK:
                        break
            continue
        if name in _RAW:
            if (opened.get("svg") or opened.get("math")) and m[3].endswith("/"):
                continue
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = close.end() if close else size
            continue
        drawn = opened.get("svg") or opened.get("math")
        if m[3].endswith("/") and (drawn or name in _DRAWN):
            continue
        if drawn and name in _BLOCK:
            end(next(k for k in range(1, len(stack)) if stack[k][0] in _DRAWN))
        if name not in _BLOCK:
            if name == "br":
                parts.append(" ")
            if name not in _VOID:
                nodes.inline[stack[-1][1]] += 1
                stack.append((name, stack[-1][1]))
                opened[name] = opened.get(name, 0) + 1
                links += name == "a"
            continue
        flush()
        if name in _CLOSES_P and opened.get("p") and (k := last_open(_names("p"), _TAKES_NO_P)) > 0:
            end(k)
        if name in _ENDS:
            names, bound = _ENDS[name]
            if any(opened.get(n) for n in names):
                while (k := last_open(names, bound)) > 0:
                    end(k)
        if name in _HEADINGS and stack[-1][0] in _HEADINGS:
            end(len(stack) - 1)
        if name in ("html", "body") or name in _VOID:
            continue  # the page itself
        above = stack[-1][1]
        titled = name == "header" and (opened.get("article") or opened.get("main"))  # an article's own title
        stack.append((name, nodes.add(page, above, nodes.depth[above] + 1, "div" if titled else name, m[3])))
        opened[name] = opened.get(name, 0) + 1
    flush()


def _up(nodes_by_depth: list[np.ndarray], parent: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums over whole subtrees."""
    total = values.astype(float)
    for at in reversed(nodes_by_depth[1:]):
        np.add.at(total, parent[at], total[at])
    return total


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 1)) if len(depth) else []
    return np.split(order, cuts)


#: Columns that name an element's purpose, and those of them that hold words of class and id.
_NAMING, _WORDS = slice(0, 2 + _HASHED), slice(2, 2 + _HASHED)


@dataclass
class _Tree:
    """The nodes of many pages as arrays, with sums over their subtrees."""

    parent: np.ndarray
    page: np.ndarray
    levels: list[np.ndarray]
    #: The node above, for a page itself; and the page's own node.
    up: np.ndarray
    root: np.ndarray
    sub: dict[str, np.ndarray]
    #: -1 inside an element made for something else, 1 inside one made for the article, 0 neither.
    place: np.ndarray
    #: Whether the page has an element made for the article.
    told: np.ndarray


def _tree(nodes: Nodes) -> _Tree:
    column = lambda name: np.array(getattr(nodes, name), np.int64)
    parent, page = column("parent"), column("page")
    levels = _levels(column("depth"))
    up = np.where(parent < 0, np.arange(len(parent)), parent)
    root = np.zeros(int(page.max()) + 1 if len(page) else 0, np.int64)
    root[page[::-1]] = np.arange(len(page))[::-1]
    root = root[page]
    sub = {n: _up(levels, parent, column(n)) for n in ("chars", "linked", "marks", "words", "inline")}
    sign = column("sign")
    # What holds an article or nearly all text is a mere wrapper, whatever its name.
    holds = _up(levels, parent, sign > 0) - (sign > 0)
    sign = np.where((sign < 0) & ((holds > 0) | (sub["chars"] > 0.9 * sub["chars"][root])), 0, sign)
    inside, outside = sign > 0, sign < 0
    for at in levels[1:]:
        inside[at] |= inside[up[at]]
        outside[at] |= outside[up[at]]
    told = (_up(levels, parent, sign > 0) > 0)[root]
    return _Tree(parent, page, levels, up, root, sub, np.where(outside, -1, inside.astype(np.int64)), told)


def features(nodes: Nodes, tree: _Tree | None = None) -> np.ndarray:
    """One row per node: names and attributes, depth, subtree density, siblings, place in the page."""
    t = tree or _tree(nodes)
    column = lambda name: np.array(getattr(nodes, name), np.int64)
    up, sub, n = t.up, t.sub, len(t.page)
    chars, linked, words, marks = (column(c) for c in ("chars", "linked", "words", "marks"))
    size = _up(t.levels, t.parent, np.ones(n))
    whole = np.maximum(sub["chars"][t.root], 1)
    siblings = np.bincount(up, minlength=n)[up]
    family = np.bincount(up, sub["chars"], minlength=n)[up]
    first = np.full(n, n)
    np.minimum.at(first, up, np.arange(n))
    before = np.concatenate(([0], np.cumsum(chars)))[:-1]
    hashed, kind = column("hashed"), column("kind")
    rows = [t.place, t.told, *[(hashed >> k) & 1 for k in range(_HASHED)]]
    rows += [
        column("depth"),
        kind == 1,
        kind == 2,
        kind == 3,
        kind == 4,
        np.log1p(chars),
        np.log1p(sub["chars"]),
        sub["chars"] / whole,
        sub["chars"] / (size + sub["inline"]),
        sub["linked"] / np.maximum(sub["chars"], 1),
        linked / np.maximum(chars, 1),
        sub["marks"] / np.maximum(sub["words"], 1),
        sub["chars"] / np.maximum(sub["words"], 1),
        np.log1p(size),
        np.log1p(siblings),
        (np.arange(n) - first[up]) / np.maximum(size[up], 1),
        np.log1p(family / np.maximum(siblings, 1)),
        family / whole,
        (before - before[t.root]) / whole,
        sub["linked"][up] / np.maximum(sub["chars"][up], 1),
    ]
    return np.stack([np.asarray(r, np.float64) for r in rows], axis=1)


def seeds(nodes: Nodes, tree: _Tree | None = None) -> np.ndarray:
    """1 for nodes of a page's article, 0 for those outside, -1 where the page doesn't show it; no word of class or id counts.

    The article is the largest element made for one; on a page without, it is the
    node whose own text and paragraphs hold most text that isn't linked, if that
    is SHOWN characters and half of the page's. Elements made for something else
    are outside wherever they stand; nodes above the article, and in a second
    element made for one, are not labelled.
    """
    t = tree or _tree(nodes)
    n = len(t.page)
    if not n:
        return np.zeros(0, np.int64)
    column = lambda name: np.array(getattr(nodes, name), np.int64)
    free = np.where(t.place < 0, 0, column("chars") - column("linked"))
    prose = free + np.bincount(t.up, np.where((column("kind") == 2) & (t.parent >= 0), free, 0), minlength=n)
    shown = (prose >= SHOWN) & (2 * prose >= t.sub["chars"][t.root]) & (t.parent >= 0)
    weight = np.where(t.told, np.where((column("sign") > 0) & (t.place > 0), 1 + t.sub["chars"], 0), np.where(shown, prose, 0))
    best = np.zeros(int(t.page.max()) + 1)
    np.maximum.at(best, t.page, weight)
    order = np.flatnonzero((weight > 0) & (weight == best[t.page]))[::-1]
    article = np.zeros(n, bool)
    picked = np.full(len(best), -1)
    picked[t.page[order]] = order  # the first of equals
    article[picked[picked >= 0]] = True
    inside = article.copy()
    for at in t.levels[1:]:
        inside[at] |= inside[t.up[at]]
    above = _up(t.levels, t.parent, article) > 0
    label = np.where(inside, 1, np.where(above | (t.place > 0) | (picked[t.page] < 0), -1, 0))
    return np.where(t.place < 0, 0, label)


def kept_nodes(nodes: Nodes, score: np.ndarray) -> np.ndarray:
    """Which nodes' own text stays, so that no node stays inside a dropped one.

    A node is opened if its score and what its opened children add are more than
    nothing; dropping it drops its subtree. Of all choices that keep only
    nodes with kept ancestors, this has the greatest sum of scores. An opened node
    with a negative score of its own is a mere wrapper: its own text goes.
    """
    parent, levels = np.array(nodes.parent, np.int64), _levels(np.array(nodes.depth, np.int64))
    gain = score.copy()
    for at in reversed(levels[1:]):
        np.add.at(gain, parent[at], np.maximum(gain[at], 0))
    opened = gain > 0
    opened[levels[0]] = True
    for at in levels[1:]:
        opened[at] &= opened[parent[at]]
    return opened & (score > 0)


def main_texts(pages: list[str | None], model: Trees) -> list[str]:
    """Blocks of kept nodes in page order, one line each."""
    nodes = Nodes()
    for k, html in enumerate(pages):
        parse(nodes, k, html or "")
    if not nodes.page:
        return []
    kept = kept_nodes(nodes, np.clip(model.score(features(nodes)), -4, 4))
    lines: list[list[str]] = [[] for _ in pages]
    for node, text in zip(nodes.owner, nodes.text):
        if kept[node]:
            lines[nodes.page[node]].append(text)
    return ["\n".join(x) for x in lines]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of nodes that their page labels."""
    for batch in chunks(batches, "html"):
        nodes = Nodes()
        for k, html in enumerate(batch.column(1).to_pylist()):
            parse(nodes, k, html or "")
        tree = _tree(nodes)
        x, y = features(nodes, tree), seeds(nodes, tree)
        known = y >= 0
        at = np.array(batch.column(0).to_pylist(), np.int64)[np.array(nodes.page, np.int64)[known]]
        rows = pa.array(list(x[known]), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(y[known].astype(np.int32)), rows], ["at", "label", "x"])


def learn(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees from labelled nodes and two altered copies of them.

    One copy has no names at all, so that shape decides where a page names
    nothing; in the other the words of class and id are those of other nodes, so
    that no word outweighs what the shape says.
    """
    unnamed, mixed = x.copy(), x.copy()
    unnamed[:, _NAMING] = 0
    mixed[:, _WORDS] = x[np.random.default_rng(7).permutation(len(x)), _WORDS]
    return boost(np.concatenate((x, unnamed, mixed)), np.concatenate((y, y, y)), depth=DEPTH)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, y, x = [], [], []
    for batch in batches:
        at += batch.column(0).to_pylist()
        y += batch.column(1).to_pylist()
        x += batch.column(2).to_pylist()
    if len(set(y)) < 2:
        return
    x, y = np.array(x), np.array(y, float)
    order = np.lexsort((*x.T, y, at))  # the same trees however the rows came
    model = learn(x[order], y[order])
    parts = [np.array([model.base]), model.features.astype(float), model.bounds, model.values]
    columns = [pa.array([p.ravel().tolist()], pa.list_(pa.float64())) for p in parts]
    yield pa.RecordBatch.from_arrays(columns, ["base", "features", "bounds", "values"])


def by_element() -> Trees:
    """What stands in an element made for something else is left out, all else stays."""
    return Trees(0.0, np.array([[0]]), np.array([[-0.5]]), np.array([[-1.0, 1.0]]))


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Trees:
    """Trees learned from at most ``sample`` pages, picked by a hash of id and html.

    Nodes are labelled by where they stand, see ``seeds``. Without labels of both
    kinds all is kept but elements made for something else.
    """
    short = pages.where(F.length("html") <= SAMPLE_CHARS)
    picked = hashed_sample(short.select(F.xxhash64("page_id", "html").alias("at"), "html"), "at", sample)
    array = "array<double>"
    found = (
        picked.mapInArrow(_sampled, f"at long, label int, x {array}")
        .repartition(1)
        .mapInArrow(_fit, f"base {array}, features {array}, bounds {array}, values {array}")
        .first()
    )
    if not found:
        return by_element()
    inner = 2**DEPTH - 1
    trees = len(found["features"]) // inner
    return Trees(
        found["base"][0],
        np.array(found["features"]).astype(np.int64).reshape(trees, inner),
        np.array(found["bounds"]).reshape(trees, inner),
        np.array(found["values"]).reshape(trees, inner + 1),
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``: the article without what surrounds it.

    References are decoded, white space inside a block is one space, blocks are
    joined by line feeds. Null and empty pages have an empty text; repeated rows
    each give a row; an empty table gives none.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    model = train(source)
    shared = pages.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(**shared.value)
        for batch in chunks(batches, "html"):
            texts = main_texts(batch.column(2).to_pylist(), trees)
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
