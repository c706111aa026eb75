"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements whose leaves are the runs of text between block
boundaries.  Boosted trees score every node by text and link density of its subtree,
its attribute and tag tokens and those of its ancestors, depth, and its place among its
siblings.  A node is "main" if it holds any article text.  The labels kept are the most
likely ones in which no main node lies below one that is not, found by a bottom-up
dynamic programme; so a heading in a menu cannot survive its menu.

The trees are fitted on pages written by a generator of common layouts (``training_pages``,
bounded by ``TRAINING_PAGES``); no page of the corpus is needed for that.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 1500
TREES, DEPTH, RATE, BINS = 60, 5, 0.3, 24
#: pages scored at once
SLAB = 500

# ---- Fixed values: kinds of HTML elements
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "template", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "object", "ol", "optgroup", "option", "p",
    "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPE = {"ul", "ol", "dl", "table", "select", "html", "body", "td", "th"}
# ---- end of fixed values

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value only after "="; elsewhere it is a character like any other
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"""
    r"""(?P<attrs>(?:[^>=]++|=(?!\s*["'])|=\s*"[^"]*"|=\s*'[^']*')*+)(?P<close>>|\Z)"""
    r"|</?[a-zA-Z].*"  # a quote that never closes takes the rest
    r"|</[^>]*(?:>|\Z)"
    r"|(?P<text><?[^<]*)",
    re.DOTALL,
)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE) for tag in RAW}


class Node:
    __slots__ = ("tag", "parent", "tokens", "text", "chars", "links", "marks", "leaves", "items", "children", "depth", "main", "at")

    def __init__(self, tag: str, parent: Node | None, tokens: tuple[str, ...], at: int):
        self.tag, self.parent, self.tokens, self.at = tag, parent, tokens, at
        self.text: str | None = None
        self.chars = self.links = self.marks = self.leaves = self.items = 0
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.main = parent.main if parent else False
        if parent:
            parent.children.append(self)


@cache
def _tag_tokens(tag: str) -> tuple[str, ...]:
    return (tag,)


def _attributes(tag: str, source: str) -> tuple[tuple[str, ...], str | None]:
    if "=" not in source:
        return _tag_tokens(tag), None
    tokens, main = [tag], None
    for name, a, b, c in _ATTR.findall(source):
        value = a or b or c
        if name.lower() == "data-main":
            main = value
        else:
            tokens += [t.lower() for t in _PARTS.findall(value)]
    return tuple(dict.fromkeys(tokens)), main


def parse(page: str) -> list[Node]:
    """Block elements and text leaves in page order; a parent stands before its children."""
    root = Node("html", None, ("html",), 0)
    nodes, here = [root], root
    pending: list[str] = []
    linked = in_link = at = pos = 0
    size = len(page)

    def flush() -> None:
        nonlocal linked, at
        if pending:
            text = " ".join("".join(pending).split())
            pending.clear()
            if text:
                leaf = Node("#text", here, _tag_tokens("#text"), at)
                leaf.text, leaf.chars, leaf.links = text, len(text), min(linked, len(text))
                leaf.marks = text.count(",") + text.count(".")
                at += len(text)
                nodes.append(leaf)
        linked = 0

    while pos < size:
        m = _TOKEN.match(page, pos)
        pos = m.end() if m.end() > pos else pos + 1
        text = m["text"]
        if text is not None:
            text = html.unescape(text)
            pending.append(text)
            if in_link:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None or not m["close"]:
            continue  # comment, declaration, or a tag cut off by the end of the page
        tag = tag.lower()
        if m["end"]:
            if tag == "a":
                in_link = 0
            elif tag in BLOCK:
                node = here
                while node is not None and node.tag != tag:
                    node = node.parent
                if node is not None and node is not root:
                    flush()
                    here, in_link = node.parent, 0
            continue
        if tag in RAW:
            stop = _RAW_END[tag].search(page, pos)
            if tag != "svg":
                pos = stop.start() if stop else size
            elif stop and not m["attrs"].endswith("/"):  # a drawing may be empty, and ends with what is no drawing
                pos = stop.start()
        elif tag == "a":
            in_link = 1
        elif tag == "br":
            pending.append(" ")
        elif tag == "hr":
            flush()
        elif tag in BLOCK and tag not in VOID:
            flush()
            in_link = 0
            node = here
            shut = CLOSES.get(tag, ())
            while node is not None and node.tag not in SCOPE:
                if node.tag == "p" or node.tag in shut:
                    here = node.parent
                    if node.tag == "p" and not shut:
                        break
                node = node.parent
            if node is not None and node.tag in shut:
                here = node.parent
            tokens, main = _attributes(tag, m["attrs"])
            if tag in ("html", "body") and here.tag in ("html", "body", "head"):
                here = root
            here = Node(tag, here, tokens, at)
            if main is not None:
                here.main = main == "1"
            nodes.append(here)
    flush()
    for node in reversed(nodes):  # sums of subtrees
        if node.text is not None:
            node.leaves = 1
        up = node.parent
        if up:
            up.chars += node.chars
            up.links += node.links
            up.marks += node.marks
            up.leaves += node.leaves
            up.items += node.items + (node.tag == "li")
    return nodes


# ---- features ----------------------------------------------------------------

N_ODDS = 4
N_PLAIN = 15 + N_ODDS


def plain_features(nodes: list[Node]) -> list[tuple]:
    total = max(nodes[0].chars, 1)
    out = []
    for n in nodes:
        up = n.parent or n
        siblings = up.children
        chars = max(n.chars, 1)
        out.append(
            (
                math.log1p(n.chars),
                n.links / chars,
                n.chars / max(n.leaves, 1),
                n.depth,
                len(n.children),
                n.leaves,
                n.items / max(n.leaves, 1),
                len(siblings),
                n.chars / max(up.chars, 1),
                up.links / max(up.chars, 1),
                up.chars / max(up.leaves, 1),
                n.marks / chars,
                n.at / total,
                n.chars / total,
                up.chars / total,
            )
        )
    return out


class Features:
    """Plain features, log odds of the tokens, one column per token of the node, one per token above it."""

    def __init__(self, odds: dict[str, float]):
        self.column = {t: i for i, t in enumerate(sorted(odds))}
        self.odds = odds

    def matrix(self, pages: list[list[Node]]) -> np.ndarray:
        size = len(self.column)
        plain = [f for nodes in pages for f in plain_features(nodes)]
        out = np.zeros((len(plain), N_PLAIN + 2 * size), np.float32)
        rows, columns, odds = [], [], []
        row = 0
        for nodes in pages:
            above: dict[int, tuple[frozenset, float, float]] = {}
            for n in nodes:
                known = [t for t in n.tokens if t in self.column]
                own = [self.column[t] for t in known]
                over, lowest, nearest = above[id(n.parent)] if n.parent else (frozenset(), 0.0, 0.0)
                worth = [self.odds[t] for t in known]
                low, high = min(worth, default=0.0), max(worth, default=0.0)
                odds.append((low, high, lowest, nearest))
                rows += [row] * (len(own) + len(over))
                columns += [N_PLAIN + c for c in own]
                columns += [N_PLAIN + size + c for c in over]
                if n.text is None:
                    above[id(n)] = over.union(own), min(lowest, low), low if low < 0 else high
                row += 1
        if plain:
            out[:, : N_PLAIN - N_ODDS], out[:, N_PLAIN - N_ODDS : N_PLAIN] = plain, odds
        out[rows, columns] = 1
        return out


# ---- boosted trees -----------------------------------------------------------


class Trees:
    """Gradient-boosted trees of fixed depth, logistic loss, splits on binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        plain = x[:, :N_PLAIN]
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in plain.T]
        code = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, plain.T)], axis=1)
        code += np.arange(N_PLAIN) * (BINS + 1)
        width = x.shape[1] - N_PLAIN
        row, column = np.nonzero(x[:, N_PLAIN:])  # a node has few tokens
        inner = 2**DEPTH - 1
        self.feature = np.zeros((TREES, inner), np.int64)
        self.cut = np.full((TREES, inner), np.inf, np.float32)
        self.value = np.zeros((TREES, inner + 1))
        score, every = np.zeros(len(x)), np.arange(len(x))
        for t in range(TREES):
            p = 1 / (1 + np.exp(-score))
            slopes = (y - p, p * (1 - p))
            leaf = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                first, n = 2**level - 1, 2**level
                at = leaf - first
                total = [np.bincount(at, s, n)[:, None] for s in slopes]
                bins = n * N_PLAIN * (BINS + 1)
                held = (at[:, None] * (N_PLAIN * (BINS + 1)) + code).ravel()
                plains = [np.bincount(held, np.repeat(s, N_PLAIN), bins).reshape(n, N_PLAIN, -1).cumsum(axis=2) for s in slopes]
                named = [np.bincount(at[row] * width + column, s[row], n * width).reshape(n, width) for s in slopes]
                # sums of the rows at or below each cut, token columns after the others
                g, h = (np.hstack([b.reshape(n, -1), a - w]) for a, b, w in zip(total, plains, named))
                all_g, all_h = total
                gain = g**2 / (h + 1) + (all_g - g) ** 2 / (all_h - h + 1) - all_g**2 / (all_h + 1)
                gain[(h < 1) | (all_h - h < 1)] = 0
                for node, best in enumerate(gain.argmax(axis=1).tolist()):
                    f, b = divmod(best, BINS + 1)
                    if gain[node, best] <= 1e-6:
                        continue
                    if f >= N_PLAIN:
                        self.feature[t, first + node], self.cut[t, first + node] = best - N_PLAIN * BINS, 0.5
                    elif b < len(cuts[f]):
                        self.feature[t, first + node], self.cut[t, first + node] = f, cuts[f][b]
                leaf = 2 * leaf + 1 + (x[every, self.feature[t, leaf]] > self.cut[t, leaf])
            leaf -= inner
            g, h = (np.bincount(leaf, s, inner + 1) for s in slopes)
            self.value[t] = RATE * g / (h + 1.0)
            score += self.value[t, leaf]
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(TREES):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            score += self.value[t, node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-score))


def decode(nodes: list[Node], p: np.ndarray) -> list[str]:
    """Texts of the leaves that are main in the most likely labels without a main node below another."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    yes, no = np.log(p).tolist(), np.log(1 - p).tolist()
    at = {id(n): i for i, n in enumerate(nodes)}
    up = [at[id(n.parent)] if n.parent else -1 for n in nodes]
    none, best = no[:], yes[:]  # of the subtree: all not main; the node main and the best below
    for i in range(len(nodes) - 1, 0, -1):
        none[up[i]] += none[i]
        best[up[i]] += max(none[i], best[i])
    main = [True] * len(nodes)
    for i in range(1, len(nodes)):
        main[i] = main[up[i]] and best[i] > none[i]
    return [n.text for n, ok in zip(nodes, main) if ok and n.text is not None]


# ---- training pages ----------------------------------------------------------

# ---- Fixed values: names that common layouts give to parts of a page
MAIN_NAMES = (
    "article", "post", "content", "entry content", "post content", "article body", "story", "story body", "main content",
    "text", "body text", "single post", "page content", "blog post", "news item", "article text", "markdown", "prose",
)
BOILERPLATE = {
    "menu": ("nav", "menu", "navbar", "navigation", "topnav", "main menu", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "tabs"),
    "header": ("header", "masthead", "site header", "page header", "top bar", "topbar", "branding", "logo", "banner", "hero"),
    "footer": ("footer", "site footer", "page footer", "bottom", "copyright", "legal", "colophon", "credits", "disclaimer"),
    "side": ("sidebar", "aside", "widget", "side", "related", "related posts", "recommended", "trending", "popular", "more stories", "read more", "tags", "archive", "recent posts"),
    "notice": ("notice", "cookie", "cookie banner", "cookie notice", "consent", "gdpr", "alert", "message", "popup", "modal", "overlay", "announcement", "warning", "paywall", "toast"),
    "ad": ("ad", "ads", "advert", "advertisement", "ad slot", "sponsor", "sponsored", "promo", "promotion", "adsense", "banner ad", "affiliate", "partner"),
    "form": ("form", "newsletter", "subscribe", "signup", "login", "search", "search form", "contact form", "register", "poll", "survey"),
    "comments": ("comments", "comment", "comment list", "comments area", "discussion", "replies", "reply", "responses", "disqus", "thread", "reader comments", "user comment"),
    "share": ("share", "social", "sharing", "share buttons", "follow", "author bio", "byline", "meta", "post meta", "toolbar"),
}
TAGS = {
    "menu": ("nav", "nav", "div", "ul"), "header": ("header", "header", "div"), "footer": ("footer", "footer", "div"),
    "side": ("aside", "aside", "div", "section"), "notice": ("div", "div", "section", "dialog", "aside"), "ad": ("div", "div", "aside", "section"),
    "form": ("form", "form", "div"), "comments": ("section", "div", "ol", "ul"), "share": ("div", "ul"),
}
# ---- end of fixed values


def _spelled(rng: np.random.Generator, name: str) -> str:
    words = name.split()
    joined = (("-", "_", "").__getitem__(rng.integers(3))).join(words)
    return joined if rng.random() < 0.8 else words[0] + "".join(w.title() for w in words[1:])


def _attrs(rng: np.random.Generator, names: tuple[str, ...] | None, chance: float) -> str:
    if names is None or rng.random() > chance:
        return "" if rng.random() < 0.7 else f' class="{("box", "wrapper", "row", "col", "inner", "block", "container")[rng.integers(7)]}"'
    value = _spelled(rng, names[rng.integers(len(names))])
    return f' {("class", "class", "id")[rng.integers(3)]}="{value}"'


def _words(rng: np.random.Generator, least: int, most: int) -> str:
    n = int(rng.integers(least, most + 1))
    words = ["x" * int(k) for k in rng.integers(2, 9, n)]
    for i in range(7, n, 11):
        words[i] += ",." [rng.integers(2)]
    return " ".join(words) + ("." if rng.random() < 0.85 else "")


def _boilerplate(rng: np.random.Generator, kind: str, named: bool) -> str:
    tag = TAGS[kind][rng.integers(len(TAGS[kind]))]
    plain = tag in ("div", "section", "ul", "ol")
    attrs = _attrs(rng, BOILERPLATE[kind], 0.95 if plain or named else 0.4)
    links = lambda a, b: "".join(f'<li><a href="/">{_words(rng, 1, b)}</a></li>' for _ in range(int(rng.integers(a, 9))))
    if kind in ("menu", "share") or (kind == "side" and rng.random() < 0.5):
        inner = links(2, 3) if tag in ("ul", "ol") else f"<ul>{links(2, 6 if kind == 'side' else 3)}</ul>"
        if kind == "side":
            inner = f"<h3>{_words(rng, 1, 4)}</h3>{inner}"
    elif kind == "comments":
        inner = "".join(
            f"<{'li' if tag in ('ol', 'ul') else 'div'}{_attrs(rng, ('comment', 'reply', 'comment body'), 0.7)}><p>{_words(rng, 3, 60)}</p>"
            f"</{'li' if tag in ('ol', 'ul') else 'div'}>"
            for _ in range(int(rng.integers(1, 8)))
        )
    elif kind == "form":
        inner = f"<label>{_words(rng, 1, 5)}</label><input><p>{_words(rng, 2, 15)}</p><button>{_words(rng, 1, 2)}</button>"
    elif kind == "header":
        inner = f"<h1>{_words(rng, 1, 4)}</h1><p>{_words(rng, 2, 10)}</p>" if rng.random() < 0.6 else _words(rng, 1, 8)
    else:
        text = _words(rng, 2, 40)
        inner = text if rng.random() < 0.5 else f"<p>{text}</p>" + (f"<p>{_words(rng, 2, 30)}</p>" if rng.random() < 0.4 else "")
    return f'<{tag}{attrs} data-main="0">{inner}</{tag}>'


def _article(rng: np.random.Generator) -> str:
    tag = ("article", "article", "main", "div", "div", "section")[rng.integers(6)]
    attrs = _attrs(rng, MAIN_NAMES, 0.9 if tag in ("div", "section") else 0.4)
    if tag == "div" and not attrs and rng.random() < 0.5:
        attrs = ' class="content"'
    parts = []
    if rng.random() < 0.85:
        title = f"<h1>{_words(rng, 1, 12)}</h1>"
        parts.append(f"<header>{title}</header>" if rng.random() < 0.15 else title)
    for _ in range(int(rng.integers(1, 14)) if rng.random() < 0.8 else 1):
        kind = rng.random()
        if kind < 0.72:
            parts.append(f"<p>{_words(rng, 1, 120) if rng.random() < 0.85 else _words(rng, 1, 3)}</p>")
        elif kind < 0.80:
            parts.append(f"<h{rng.integers(2, 5)}>{_words(rng, 1, 8)}</h{rng.integers(2, 5)}>")
        elif kind < 0.86:
            parts.append("<ul>" + "".join(f"<li>{_words(rng, 1, 25)}</li>" for _ in range(int(rng.integers(2, 6)))) + "</ul>")
        elif kind < 0.90:
            parts.append(f"<blockquote>{_words(rng, 5, 40)}</blockquote>")
        elif kind < 0.93:
            parts.append(f"<table><tr><td>{_words(rng, 1, 5)}</td><td>{_words(rng, 1, 5)}</td></tr></table>")
        elif kind < 0.96:
            parts.append(f"<div>{_words(rng, 10, 60)}</div>")
        elif kind < 0.98:
            parts.append(f"<p><a href='/'>{_words(rng, 1, 5)}</a> {_words(rng, 10, 40)}</p>")
        else:
            parts.append(f"<pre>{_words(rng, 5, 30)}</pre>")
        if rng.random() < 0.06:
            parts.append(_boilerplate(rng, ("ad", "share", "side", "form", "notice")[rng.integers(5)], True))
    if rng.random() < 0.12:
        parts.append(_boilerplate(rng, ("comments", "share", "footer", "side")[rng.integers(4)], True))
    return f'<{tag}{attrs} data-main="1">{"".join(parts)}</{tag}>'


def training_pages(n: int = TRAINING_PAGES, seed: int = 7) -> list[str]:
    """Pages in common layouts; ``data-main`` tells which parts are article text."""
    rng = np.random.default_rng(seed)
    pages = []
    for _ in range(n):
        around = [k for k in BOILERPLATE if k not in ("share",) and rng.random() < 0.45]
        before = [k for k in around if k in ("menu", "header", "notice") or k in ("ad", "side", "form") and rng.random() < 0.5]
        after = [k for k in around if k not in before]
        main = _article(rng)
        for _ in range(int(rng.integers(0, 3))):
            extra = _boilerplate(rng, ("side", "ad", "comments")[rng.integers(3)], False) if rng.random() < 0.4 else ""
            main = f"<div{_attrs(rng, None, 1)}>{main}{extra}</div>"
        body = "".join(_boilerplate(rng, k, False) for k in before) + main + "".join(_boilerplate(rng, k, False) for k in after)
        pages.append(f"<!DOCTYPE html><html><head><title>x</title></head><body data-main='0'>{body}</body></html>")
    return pages


def _labels(nodes: list[Node]) -> np.ndarray:
    main = {id(n): n.text is not None and n.main for n in nodes}
    for n in reversed(nodes):
        if main[id(n)] and n.parent:
            main[id(n.parent)] = True
    return np.array([main[id(n)] for n in nodes], np.float64)


class Extractor:
    def __init__(self, pages: list[str]):
        parsed = [parse(p) for p in pages]
        labels = [_labels(nodes) for nodes in parsed]
        seen: dict[str, list[int]] = {}
        for nodes, own in zip(parsed, labels):
            for n, main in zip(nodes, own.tolist()):
                for t in n.tokens:
                    seen.setdefault(t, [0, 0])[int(main)] += 1
        self.features = Features({t: math.log((m + 1) / (o + 1)) for t, (o, m) in seen.items() if m + o >= 3})
        self.trees = Trees().fit(self.features.matrix(parsed), np.concatenate(labels))

    def texts(self, pages: list[str | None]) -> list[str]:
        parsed = [parse(p or "") for p in pages]
        p = self.trees.probability(self.features.matrix(parsed))
        ends = np.cumsum([len(nodes) for nodes in parsed])
        return ["\n\n".join(decode(nodes, own)) for nodes, own in zip(parsed, np.split(p, ends[:-1]))]


def extract_text(
    pages: DataFrame,
    extractor: Extractor | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (blocks joined by an empty line), ``n_chars``.

    Null and empty pages give an empty text.  A page cut off anywhere is read as far as
    it goes; character references are decoded, white space inside a block becomes one
    space.  Null ids and urls and repeated rows pass through, an empty table gives no
    rows, other columns are not read.
    """
    model = extractor or Extractor(training_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLAB):
                part = batch.slice(at, SLAB)
                texts = model.texts(part.column("_html").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"),
                        part.column("_url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=[id_column, url_column, "text", "n_chars"],
                )

    rows = pages.select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(url_column).cast("string").alias("_url"),
        F.col(html_column).cast("string").alias("_html"),
    )
    return rows.mapInArrow(run, f"`{id_column}` long, `{url_column}` string, text string, n_chars long")
