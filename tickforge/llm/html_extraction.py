"""Main text of HTML pages by a tree-structured graphical model.

A page becomes a tree of its elements. Each has two states, content or not; features of the element (tag, words of class,
id and role, its text's length, links and end marks) give its own potential, and potentials between parent and child tie
them. Messages go from the leaves up and from the root down (sum-product, exact on a tree) and give marginals. Weights are
trained on labelled pages that this module composes from a seeded grammar of menus, notices, adverts, forms, comments and
articles, so that no table is needed: by the likelihood of each
element given its parent.

The text of blocks whose element is content, in page order: character references decoded, white space turned into one
space, trimmed, joined by a line feed. Scripts, styles, heads, comments and drawings (svg, canvas) are markup and have no
text, nor have form controls and what a browser shows only if it can't show something else (noscript, object, iframe).
Formulas (math) are text of their block. Null or empty html gives an empty text. Unclosed and stray tags are allowed, a tag cut off by the end of the page is dropped. Scripts, styles,
text areas and titles are raw up to their end tag (without one, up to the page's end, as in HTML). A head ends at its end
tag or at the first text or element that cannot stand in it; other hidden elements count only if they have an end tag.
Pages of any length and depth are read whole, in time that grows with their length. Repeated rows are read each for itself.
Extra columns of any name pass, but one named text gives way to the result. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A tag ends at the first > outside a value; quotes open a value behind = only, and one that never closes is no quote.
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
SPACES = re.compile(r"\s+")
#: Elements by their part in a page.
ROOTS = frozenset(("html", "body"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template title svg iframe object select textarea button canvas".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in ("script", "style", "textarea", "title")}
HEAD = frozenset("html head base link meta title script style noscript template".split())
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace mpadded semantics".split())
TAGS = ["nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "ul", "ol", "li", "table", "td", "h1", "h2", "h3", "blockquote", "pre", "body", "dl", "figure", "fieldset", "dialog", "menu"]
BAD = ("nav", "menu", "header", "foot", "sidebar", "side", "aside", "banner", "advert", "ad", "ads", "sponsor", "promo", "cookie", "notice", "consent", "popup", "modal", "newsletter", "subscribe", "form", "search", "login", "comment", "comments", "reply", "discussion", "share", "social", "related", "breadcrumb", "widget", "copyright", "legal", "disclaimer", "pagination")
GOOD = ("article", "content", "post", "entry", "main", "story", "body", "text")
#: A start tag of the left ends an open element of the right, up to the nearest of BARRIER.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = frozenset("ul ol dl table".split())


class Node:
    __slots__ = ("attributes", "chars", "kids", "links", "marks", "parent", "tag", "words")

    def __init__(self, tag: str, attributes: str, parent: int):
        self.tag, self.attributes, self.parent, self.kids = tag, attributes, parent, 0
        self.chars = self.links = self.marks = 0


def pieces(page: str) -> list[tuple[int, int, re.Match]]:
    """(start, end, match) of the page's markup in order. A raw element is one piece with all that is in it; so is a hidden
    one up to the end tag that belongs to it."""
    out: list[tuple[int, int, re.Match]] = []
    opened: dict[str, list[int]] = {}
    at = 0
    while m := PIECE.search(page, at):
        at = m.end()
        tag = (m[2] or "").lower()
        if tag in HIDDEN and m[4]:
            if m[1]:
                if opened.get(tag):
                    k = opened[tag].pop()
                    m_start, m_open = out[k][0], out[k][2]
                    for ks in opened.values():  # what was opened within is within
                        while ks and ks[-1] > k:
                            ks.pop()
                    del out[k:]
                    out.append((m_start, at, m_open))
                    continue
            elif not m[3].rstrip().endswith("/"):
                if tag in RAW:
                    stop = RAW[tag].search(page, at)
                    at = stop.end() if stop else len(page)
                else:
                    opened.setdefault(tag, []).append(len(out))
        out.append((m.start(), at, m))
    return out


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements (parents before children; the first is the page), and blocks of text with their elements."""
    nodes = [Node("html", "", -1)]
    stack: list[tuple[str, int]] = [("html", 0)]
    blocks: list[tuple[int, str]] = []
    held: list[str] = []
    inline: Counter[str] = Counter()  # open inline elements, all on top of the stack
    blocked: Counter[str] = Counter()  # open block elements
    head = False

    def cut(k: int) -> None:
        for t, _ in stack[k:]:
            (inline if t in INLINE else blocked)[t] -= 1
        del stack[k:]

    def close() -> None:
        text = SPACES.sub(" ", entities.unescape("".join(held))).strip()
        held.clear()
        if text:
            at = stack[-1][1]
            blocks.append((at, text))
            nodes[at].chars += len(text)
            nodes[at].marks += sum(text.count(c) for c in ".!?")

    def text(raw: str) -> None:
        held.append(raw)
        if inline["a"] > 0:
            nodes[stack[-1][1]].links += len(raw.strip())

    at = 0
    for start, after, m in pieces(page):
        if start > at:
            head = head and page[at:start].isspace()
            text(page[at:start])
        at = after
        if not m[2]:
            continue
        tag, end = m[2].lower(), bool(m[1])
        if m[4] == "":
            break
        if tag == "head":
            head = not end and not m[3].rstrip().endswith("/")
            continue
        head = head and (end or tag in HEAD)
        if head or tag in HIDDEN:
            continue
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                held.append(" ") if tag != "hr" else close()
            continue
        if tag in INLINE:
            if not end:
                stack.append((tag, stack[-1][1]))
                inline[tag] += 1
            elif inline[tag] > 0:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag)
                del stack[k]
                inline[tag] -= 1
            continue
        close()
        while stack[-1][0] in INLINE:
            cut(len(stack) - 1)
        if end:
            if blocked[tag] > 0:
                cut(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            continue
        if tag == "html" or tag == "body" and blocked[tag] > 0:
            continue
        if stack[-1][0] == "p":
            cut(len(stack) - 1)
        if tag in ENDS and any(blocked[t] > 0 for t in ENDS[tag]):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in BARRIER:
                    break
                if stack[k][0] in ENDS[tag]:
                    cut(k)
                    break
        nodes.append(Node(tag, m[3], stack[-1][1]))
        nodes[stack[-1][1]].kids += 1
        stack.append((tag, len(nodes) - 1))
        blocked[tag] += 1
    else:
        if at < len(page):
            text(page[at:])
    close()
    return nodes, blocks


@lru_cache(maxsize=20_000)
def _fixed(tag: str, attributes: str) -> tuple[int, float, float]:
    words = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label"):
            words.update(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", "".join(values)).lower()))
    return TAGS.index(tag) if tag in TAGS else len(TAGS), float(bool(words & set(BAD))), float(bool(words & set(GOOD)))


def matrix(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    x = np.zeros((n, len(TAGS) + 9))
    own = np.array([[v.chars, v.links, v.marks] for v in nodes], float)
    whole = own.copy()
    for k in range(n - 1, 0, -1):
        whole[nodes[k].parent] += whole[k]
    for k, v in enumerate(nodes):
        tag, bad, good = _fixed(v.tag, v.attributes)
        x[k, tag], x[k, len(TAGS) + 1], x[k, len(TAGS) + 2] = 1, bad, good
    base = len(TAGS) + 3
    x[:, base] = np.minimum(np.log1p(own[:, 0]), 7) / 7
    x[:, base + 1] = own[:, 1] / np.maximum(own[:, 0], 1)
    x[:, base + 2] = np.minimum(own[:, 2], 3) / 3
    x[:, base + 3] = whole[:, 1] / np.maximum(whole[:, 0], 1)
    x[:, base + 4] = np.minimum(np.log1p(whole[:, 0]), 10) / 10
    x[:, base + 5] = own[:, 0] == 0
    return x


def marginals(nodes: list[Node], unary: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """P(content) of each element; unary: log potentials of content against not; ties: how strongly a child goes with its
    parent, where that is the page or its body, and elsewhere."""
    pairs = ties[:, None, None] / 2 * np.array([[1, -1], [-1, 1]])
    n = len(nodes)
    up = np.zeros((n, 2))
    up[:, 1] = unary
    sent = np.zeros((n, 2))
    for k in range(n - 1, 0, -1):
        a = pairs[int(nodes[nodes[k].parent].tag not in ROOTS)] + up[k]
        sent[k] = np.logaddexp(a[:, 0], a[:, 1])
        up[nodes[k].parent] += sent[k]
    down = np.zeros((n, 2))
    for k in range(1, n):
        p = nodes[k].parent
        a = (up[p] + down[p] - sent[k])[:, None] + pairs[int(nodes[p].tag not in ROOTS)]
        down[k] = np.logaddexp(a[0], a[1])
        down[k] -= down[k].max()
    z = up + down
    return 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -500, 500)))


def composed(seed: int) -> tuple[str, set[str]]:
    """A labelled page: html, and the texts of its article's blocks. Every block's text is one of a kind."""
    r = random.Random(seed)
    made = [0]
    content: set[str] = set()

    def words(a: int, b: int, end: bool = True) -> str:
        made[0] += 1
        body = " ".join("".join(r.choice("aeioutnrsl") for _ in range(r.randint(1, 9))) for _ in range(r.randint(a, b)))
        return f"{body.capitalize()} {made[0]}" + ("." if end else "")

    def text(a: int, b: int, end: bool = True) -> str:
        t = words(a, b, end)
        content.add(t)
        return t

    def links(n: int) -> str:
        return "".join(f"<li><a href='/{k}'>{words(1, 2, False)}</a></li>" for k in range(n))

    def noise() -> str:
        c, kind = r.choice(BAD), r.randint(0, 8)
        wrap = r.choice(["div", "section", "aside", "ul"]) if kind else "div"
        if kind == 0:
            return f"<div class='{c}'>{words(3, 30)}</div>"
        if kind == 1:
            return f"<nav><ul>{links(r.randint(3, 9))}</ul></nav>"
        if kind == 2:
            return f"<aside><h3>{words(1, 3, False)}</h3><ul>{links(4)}</ul><p>{words(5, 25)}</p></aside>"
        if kind == 3:
            return f"<form><label>{words(1, 3, False)}</label><input><p>{words(3, 12)}</p></form>"
        if kind == 4:
            return f"<section class='comments'><h3>{words(1, 2, False)}</h3>" + "".join(f"<div class='comment'><p>{words(5, 50)}</p></div>" for _ in range(r.randint(1, 4))) + "</section>"
        if kind == 5:
            return f"<div class='cookie-notice' role='dialog'><p>{words(8, 30)}</p></div>"
        if kind == 6:
            return f"<{wrap} id='{c}'><p>{words(4, 40)}</p></{wrap}>"
        if kind == 7:
            return f"<div class='ad'>{' '.join(words(1, 14) for _ in range(r.randint(1, 4)))}</div>"
        return f"<div class='{c}-box'><p>{words(4, 30)}</p><p>{words(4, 30)}</p></div>"

    def article() -> str:
        parts = [f"<h1>{text(2, 9, r.random() < 0.3)}</h1>"]
        for _ in range(int(2 ** r.uniform(0, 5.5))):
            kind = r.random()
            if kind < 0.7:
                parts.append(f"<p>{text(1, int(2 ** r.uniform(1, 8)))}</p>")
            elif kind < 0.78:
                parts.append(f"<h2>{text(1, 6, False)}</h2>")
            elif kind < 0.86:
                parts.append("<ul>" + "".join(f"<li>{text(2, 20)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote><p>{text(5, 40)}</p></blockquote>")
            else:
                parts.append(noise())
        tag, extra = r.choice([("article", ""), ("main", ""), ("div", " class='post-content'"), ("div", " id='content'"), ("article", " class='entry'"), ("section", " class='story'")])
        return f"<{tag}{extra}>{''.join(parts)}</{tag}>"

    top = f"<header><p>{words(1, 6, False)}</p>{r.choice(['', noise()])}</header>" if r.random() < 0.6 else ""
    foot = f"<footer>{r.choice(['', '<p>', '&copy; site &middot; '])}{' '.join(words(1, 14) for _ in range(r.randint(1, 5)))}</footer>" if r.random() < 0.9 else ""
    around = [noise() for _ in range(r.randint(0, 4))]
    cut = r.randint(0, len(around))
    return f"<html><body>{top}{''.join(around[:cut])}{article()}{''.join(around[cut:])}{foot}</body></html>", content


@lru_cache(maxsize=4)
def train(pages: int = 600, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights of elements and pairs from ``pages`` composed pages."""
    xs, ys = [], []
    for k in range(pages):
        page, content = composed(seed * 100_003 + k)
        nodes, blocks = parse(page)
        y = np.zeros(len(nodes), int)
        for at, t in blocks:
            y[at] = t in content
        inside = y.copy()
        total = np.array([v.chars for v in nodes], float)
        good = total * y
        for j in range(len(nodes) - 1, 0, -1):  # an element without text of its own is content if most text below it is
            total[nodes[j].parent] += total[j]
            good[nodes[j].parent] += good[j]
        inside = np.where([v.chars > 0 for v in nodes], y, good > 0.5 * np.maximum(total, 1))
        near = np.zeros((len(nodes), 2))  # each element given its parent
        for j in range(1, len(nodes)):
            up, kind = nodes[j].parent, int(nodes[nodes[j].parent].tag not in ROOTS)
            near[j, kind] += 2 * inside[up] - 1
        xs.append(np.hstack([matrix(nodes), near])), ys.append(inside)
    x, y = np.concatenate(xs), np.concatenate(ys).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(12):  # Newton's method, ridge of a half
        p = 1 / (1 + np.exp(-(x @ w)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w)), x.T @ (p - y) + 0.5 * w)
    return w[:-2], np.maximum(w[-2:], 0)


def main_text(page: str | None, model: tuple[np.ndarray, np.ndarray]) -> str:
    if not page:
        return ""
    nodes, blocks = parse(page)
    p = marginals(nodes, matrix(nodes) @ model[0], model[1])
    return "\n".join(t for at, t in blocks if p[at] > 0.5)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with text in place of html_col, and of a column named text."""
    model = train()
    rest = [c for c in pages.columns if c not in (html_col, "text")]
    src = pages.select(F.col(f"`{html_col}`").cast("string").alias("__html"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    kinds = T.StructType([*src.schema.fields[1:], T.StructField("__text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py(), model) for x in batch.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], [*batch.schema.names[1:], "__text"])

    return src.mapInArrow(run, kinds).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("__text").alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: the main text of every page."""
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
