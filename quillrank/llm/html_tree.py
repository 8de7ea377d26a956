"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every block element is a node with the label "content" or not. A node's own potential is linear in its
tag, the words of its class and id, and its text and link amounts; each edge from parent to child has a
potential for each pair of labels. Messages pass from the leaves to the root and back, which gives the
exact marginal of every node. Text belongs to its nearest block; it is kept if that node's marginal is one
half or more. The potentials are fitted by gradient ascent on labelled pages, which ``labelled_pages``
lays out by rule, as the tables hold none: the usual parts of pages in many orders and markups.

Defined results: a null or empty page, or one without content, gives an empty text; broken or cut markup is
read as far as it goes: unknown and unclosed elements end with their parent, left-out ones at the next block if
that comes first, and a head where the body begins; text outside every block belongs to the page; pages are read whole;
rows are independent, so repeated rows and further columns do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import map_batches

# HTML element names by how they are laid out.
SKIPPED = frozenset("script style noscript template iframe svg math canvas object head select textarea button".split())
BLOCKS = frozenset(
    "html body div section article main nav header footer aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd"
    " table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary dialog"
    " menu center label legend hr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening element of this kind ends an open one of these kinds, up to the nearest other container.
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
}
_P_ENDERS = BLOCKS - {"html", "body", "label", "legend"}

COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
TAG_START = re.compile(r"<(/?)(?=[a-zA-Z])")
NAME_END = re.compile(r"[\s/>]")
TAG_MARK = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-label|data-main)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME = re.compile(r"[a-z]+")
#: End tags of elements whose inside is text up to there; a title's only in the head.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in ("script", "style", "textarea", "title")}
END_TAG = re.compile(r"</([a-zA-Z][^\s/>]*)")
IN_HEAD = frozenset("html head title meta link base style script noscript template".split())
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    names: tuple[str, ...] = ()
    parent: int = -1
    label: int | None = None
    texts: list[tuple[int, str]] = field(default_factory=list)  # (place in page order, text)
    chars: int = 0
    linked: int = 0
    stops: int = 0


class Token(NamedTuple):
    """A tag (with a name) or text; comments and declarations are empty text."""

    raw: str
    name: str | None = None
    closing: bool = False
    rest: str = ""


class _Reader:
    """Tokens by place, in one pass: what was looked for once from an earlier place is not looked for again.

    A tag ends at the first ``>`` outside quotes; one that has none, or a quote that does not end, is text.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.last = html.rfind(">")
        self.name_end = self.mark = -1  # the next ones, as far as looked for
        self.open_quotes: set[int] = set()  # places of quotes that no end of a tag follows

    def _next(self, pattern: re.Pattern, at: int) -> int:
        match = pattern.search(self.html, at)
        return match.start() if match else len(self.html)

    def _tag_end(self, at: int) -> int:
        if self.mark < at:
            self.mark = self._next(TAG_MARK, at)
        here, quotes = self.mark, []
        while here < len(self.html):
            if self.html[here] == ">":
                return here + 1
            close = -1 if here in self.open_quotes else self.html.find(self.html[here], here + 1)
            quotes.append(here)
            if close < 0:
                break
            here = self._next(TAG_MARK, close + 1)
        self.open_quotes.update(quotes)
        return -1

    def token(self, at: int) -> tuple[Token, int]:
        """The token at this place and where it ends."""
        html = self.html
        if html.startswith("<!--", at):
            return Token(""), COMMENT.match(html, at).end()
        if html[at] == "<" and at < self.last:
            if html[at + 1] in "!?":
                return Token(""), html.index(">", at) + 1
            start = TAG_START.match(html, at)
            if start:
                if self.name_end < start.end():
                    self.name_end = self._next(NAME_END, start.end())
                end = self._tag_end(self.name_end)
                if end >= 0:
                    name = html[start.end() : self.name_end].lower()
                    return Token(html[at:end], name, bool(start.group(1)), html[self.name_end : end - 1]), end
        end = html.find("<", at + 1)
        end = end if end >= 0 else len(html)
        return Token(html[at:end]), end


def tokens(html: str) -> Iterator[Token | None]:
    """Tokens of a page without the inside of scripts and the like; None stands before what follows such an inside.

    A raw element ends with its end tag only, whatever it holds; without one, a script or style sheet ends with
    an element that it stands in, and the text of the others is read as mark-up.
    """
    at, missing, opened, in_head = 0, set(), Counter(), False
    reader = _Reader(html)
    while at < len(html):
        token, at = reader.token(at)
        yield token
        name, closing = token.name, token.closing
        if name is None:
            continue
        if name == "head":
            in_head = not closing
        elif name in BLOCKS and name != "html":
            in_head = False
        if name in BLOCKS or name == "head":
            opened[name] = max(0, opened[name] - 1) if closing else opened[name] + 1
        if closing or name not in RAW or (name == "title" and not in_head):
            continue
        end = None if name in missing else RAW[name].search(html, at)
        if end:
            at = end.end()
            yield None
            continue
        missing.add(name)  # nor is there one further on
        if name not in ("script", "style"):
            continue
        at = next((m.start() for m in END_TAG.finditer(html, at) if opened[m.group(1).lower()]), len(html))
        yield None


def skips(found: list[Token | None]) -> dict[int, int]:
    """Token after each skipped element that has its end tag within its parent, by the place of its start."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    open_now: Counter = Counter()
    for i, token in enumerate(found):
        if token is None or token.name is None:
            continue
        name = token.name
        if name in VOID or not (name in BLOCKS or name in SKIPPED) or name == "head":
            continue
        if not token.closing:
            if i + 1 < len(found) and found[i + 1] is None:  # its inside is left out already
                ends[i] = i + 2
            elif name in BLOCKS or not token.rest.endswith("/"):
                stack.append((name, i))
                open_now[name] += 1
        elif open_now[name]:
            while True:
                last, start = stack.pop()
                open_now[last] -= 1
                if last == name:
                    break
            if name in SKIPPED:
                ends[start] = i + 1
    return ends


def parse(html: str) -> list[Node]:
    """Block elements in page order, parents first; node 0 is the page.

    A skipped element without an end tag in its parent ends at the next block or with its parent, the head also
    at whatever cannot be in one.
    """
    nodes = [Node("page")]
    stack = [0]
    opened: Counter = Counter()  # block elements on the stack, by name
    place, links, skipping, beyond = 0, 0, "", 0
    found = list(tokens(html))
    ends = skips(found)
    for i, token in enumerate(found):
        if token is None or i < beyond:
            continue
        name, closing = token.name, token.closing
        if name is None:
            raw = token.raw
            if not raw:
                continue
            if skipping == "head" and not raw.isspace():
                skipping = ""
            if skipping:
                continue
            text = unescape(raw)
            node = nodes[stack[-1]]
            node.texts.append((place, text))
            bare = len(text) - text.count(" ")
            node.chars += bare
            node.stops += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            if links:
                node.linked += bare
            continue
        if skipping == "head":
            if name == "title" and not closing:
                if i + 1 == len(found) or found[i + 1] is not None:
                    skipping = name
                continue
            if name not in IN_HEAD or (name == "head" and closing):
                skipping = ""
        elif skipping and (name in BLOCKS or (closing and name == skipping)):
            skipping = ""
        if name in SKIPPED:
            if not closing and i in ends:
                beyond = ends[i]
            elif not closing and not skipping and not token.rest.endswith("/"):
                skipping = name
        elif skipping:
            continue
        elif name == "a":
            links = 0 if closing else 1
        elif name == "br" or name in VOID:
            if name == "hr":
                place += 1
            elif name == "br":
                nodes[stack[-1]].texts.append((place, " "))
        elif name in BLOCKS:
            place += 1
            if closing:
                while opened[name]:
                    last = nodes[stack.pop()].tag
                    opened[last] -= 1
                    if last == name:
                        break
                links = 0
            else:
                if name in _P_ENDERS and nodes[stack[-1]].tag == "p":
                    opened[nodes[stack.pop()].tag] -= 1
                ended = CLOSES.get(name)
                while ended and nodes[stack[-1]].tag in ended:
                    opened[nodes[stack.pop()].tag] -= 1
                attributes = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(token.rest)}
                label = attributes.pop("data-main", None)
                names = tuple(NAME.findall(" ".join(attributes.values()).lower()))
                if "hidden" in attributes:
                    names += ("hidden",)
                above = nodes[stack[-1]].label
                nodes.append(Node(name, names, stack[-1], int(label) if label else above))
                stack.append(len(nodes) - 1)
                opened[name] += 1
    return nodes


def node_features(nodes: list[Node]) -> list[dict[str, float]]:
    chars = [node.chars for node in nodes]
    linked = [node.linked for node in nodes]
    for i in range(len(nodes) - 1, 0, -1):  # of the whole subtree
        chars[nodes[i].parent] += chars[i]
        linked[nodes[i].parent] += linked[i]
    whole = max(1, chars[0])
    out = []
    for i, node in enumerate(nodes):
        density = linked[i] / chars[i] if chars[i] else 0.0
        features = {"bias": 1.0, f"tag {node.tag}": 1.0, "links": density, "share": chars[i] / whole}
        features["text"] = min(1.0, math.log1p(node.chars) / 7)
        if node.chars:
            features["stops"] = min(1.0, 20 * node.stops / node.chars)
        if not chars[i]:
            features["bare"] = 1.0
        for name in set(node.names):
            features[f"name {name}"] = 1.0
        out.append(features)
    return out


@dataclass
class TreeModel:
    """Weights of node features for "content" and scores of (parent, child) label pairs."""

    weights: dict[str, float]
    edges: list[list[float]]

    def marginals(self, nodes: list[Node], features: list[dict[str, float]], pairs: list | None = None) -> list[float]:
        """Probability of "content" by node. ``pairs`` takes the joint of each edge, if given."""
        get = self.weights.get
        own = []
        for each in features:
            score = sum(get(name, 0.0) * value for name, value in each.items())
            p = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, score))))
            own.append((1.0 - p, p))
        (e00, e01), (e10, e11) = [[math.exp(v) for v in row] for row in self.edges]
        n = len(nodes)
        below = list(own)  # own potential times the messages of the children
        up = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            a, b = below[i]
            m0, m1 = e00 * a + e01 * b, e10 * a + e11 * b
            total = m0 + m1
            up[i] = m0, m1 = m0 / total, m1 / total
            c, d = below[nodes[i].parent]
            c, d = c * m0, d * m1
            total = c + d
            below[nodes[i].parent] = (c / total, d / total) if total > 0 else (0.5, 0.5)
        belief = [below[0]] + [(0.5, 0.5)] * (n - 1)
        for i in range(1, n):
            c, d = belief[nodes[i].parent]
            m0, m1 = up[i]
            c, d = c / max(m0, 1e-300), d / max(m1, 1e-300)  # the parent without this child's message
            total = c + d
            c, d = c / total, d / total
            a, b = below[i]
            joint = ((c * e00 * a, c * e01 * b), (d * e10 * a, d * e11 * b))
            total = sum(map(sum, joint)) or 1.0
            x, y = (joint[0][0] + joint[1][0]) / total, (joint[0][1] + joint[1][1]) / total
            belief[i] = x, y
            if pairs is not None:
                pairs.append([[v / total for v in row] for row in joint])
        return [b / (a + b) for a, b in belief]


def fit(pages: list[str], rounds: int = 60, rate: float = 0.5, decay: float = 0.01) -> TreeModel:
    """Gradient ascent on the likelihood of pages whose elements carry ``data-main`` 0 or 1.

    A node's label is that of its nearest labelled ancestor or itself; nodes above all labels are content.
    """
    trees = []
    for page in pages:
        nodes = parse(page)
        labels = [1 if node.label is None else node.label for node in nodes]
        features = node_features(nodes)
        trees.append((nodes, features, labels))
    model = TreeModel({}, [[0.0, 0.0], [0.0, 0.0]])
    past: dict[object, float] = {}
    for _ in range(rounds):
        slope: dict[str, float] = {}
        edge = [[0.0, 0.0], [0.0, 0.0]]
        for nodes, features, labels in trees:
            pairs: list = []
            expected = model.marginals(nodes, features, pairs)
            for each, label, p in zip(features, labels, expected):
                for name, value in each.items():
                    slope[name] = slope.get(name, 0.0) + (label - p) * value
            for i, joint in enumerate(pairs, 1):
                for a in (0, 1):
                    for b in (0, 1):
                        seen = labels[nodes[i].parent] == a and labels[i] == b
                        edge[a][b] += seen - joint[a][b]
        for name, value in slope.items():
            value -= decay * model.weights.get(name, 0.0)
            past[name] = past.get(name, 1e-2) + value * value
            model.weights[name] = model.weights.get(name, 0.0) + rate * value / math.sqrt(past[name])
        for a in (0, 1):
            for b in (0, 1):
                value = edge[a][b] - decay * model.edges[a][b]
                past[a, b] = past.get((a, b), 1.0) + value * value
                model.edges[a][b] += rate * value / math.sqrt(past[a, b])
    return model


def _sentences(draw: random.Random, n: int) -> str:
    parts = ["".join(draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(draw.randint(1, 4))) for _ in range(n)]
    for i in range(0, n, draw.randint(6, 14)):
        parts[i] = parts[i].capitalize()
        parts[i - 1] += draw.choice([".", ".", "?", ",", "!"]) if i else ""
    return " ".join(parts) + "."


def labelled_pages(n: int = 80, seed: int = 11) -> list[str]:
    """Pages laid out by rule, each element labelled by ``data-main`` on it or above it."""
    draw = random.Random(seed)
    pick = draw.choice

    def links(k: int) -> str:
        return "".join(f'<li><a href="#">{_sentences(draw, draw.randint(1, 3))}</a></li>' for _ in range(k))

    def named(words: str) -> str:
        kind = pick(["class", "class", "id"])
        return f'{kind}="{pick(words.split())}{pick(["", "", "-wrap", "-box", " block", "-area"])}"'

    def paragraph(low: int = 8, high: int = 90) -> str:
        return f"<p>{_sentences(draw, draw.randint(low, high))}</p>"

    def menu() -> str:
        return pick([
            f"<nav data-main=0><ul>{links(draw.randint(3, 9))}</ul></nav>",
            f"<nav data-main=0>{links(4)}</nav>",
            f'<div {named("menu nav navbar navigation breadcrumb breadcrumbs topbar")} data-main=0><ul>{links(5)}</ul></div>',
        ])

    def header() -> str:
        return pick([
            f"<header data-main=0><h1>{_sentences(draw, 2)}</h1>{pick(['', menu(), paragraph(3, 12)])}</header>",
            f'<div {named("header masthead site-header banner logo")} data-main=0><p>{_sentences(draw, 5)}</p></div>',
        ])

    def footer() -> str:
        return pick([
            f"<footer data-main=0>&copy; {_sentences(draw, draw.randint(3, 25))}</footer>",
            f"<footer data-main=0>{paragraph(3, 30)}<ul>{links(4)}</ul></footer>",
            f'<div {named("footer copyright legal bottom")} data-main=0>{paragraph(4, 30)}</div>',
        ])

    def aside() -> str:
        return pick([
            f"<aside data-main=0><h3>{_sentences(draw, 2)}</h3><ul>{links(5)}</ul></aside>",
            f"<aside data-main=0>{paragraph(10, 60)}</aside>",
            f'<div {named("sidebar related widget recommended popular trending rail")} data-main=0>'
            f"<h3>{_sentences(draw, 2)}</h3>{pick([paragraph(10, 60), f'<ul>{links(5)}</ul>'])}</div>",
        ])

    def notice() -> str:
        return (
            f'<div {named("cookie cookies consent notice gdpr alert popup modal overlay warning banner")} data-main=0>'
            f"{paragraph(6, 45)}{pick(['', '<button>Ok</button>'])}</div>"
        )

    def advert() -> str:
        inner = pick([_sentences(draw, draw.randint(4, 40)), paragraph(4, 40)])
        return f'<{(tag := pick(["div", "div", "section", "aside"]))} {named("ad ads advert advertisement promo sponsored sponsor adbox")} data-main=0>{inner}</{tag}>'

    def form() -> str:
        return (
            f'<form {named("newsletter signup search login subscribe contact")} data-main=0>'
            f"<label>{_sentences(draw, 4)}</label>{pick(['', paragraph(4, 25)])}<input type=text></form>"
        )

    def comments() -> str:
        own = "".join(
            f'<{(tag := pick(["li", "div", "article"]))} class="{pick(["comment", "reply", "comment-body"])}">'
            f"{pick(['', '<h4>' + _sentences(draw, 2) + '</h4>'])}{paragraph(6, 70)}</{tag}>"
            for _ in range(draw.randint(1, 5))
        )
        return f'<{(tag := pick(["section", "div", "ol"]))} {named("comments comment-list responses discussion replies disqus")} data-main=0>{own}</{tag}>'

    def share() -> str:
        return f'<div {named("share social sharing tags author byline meta")} data-main=0><ul>{links(3)}</ul></div>'

    def body() -> str:
        parts = [f"<h1>{_sentences(draw, draw.randint(2, 10))}</h1>"] if draw.random() < 0.8 else []
        for _ in range(draw.randint(1, 8)):
            parts.append(pick([
                paragraph(), paragraph(), paragraph(), paragraph(1, 6), f"<h2>{_sentences(draw, 4)}</h2>",
                f"<p><b>{_sentences(draw, 30)}<br>", f"<ul>{''.join('<li>' + _sentences(draw, 8) + '</li>' for _ in range(3))}</ul>",
                f"<blockquote>{paragraph()}</blockquote>", f"<pre>{_sentences(draw, 12)}</pre>",
                f"<table><tr><td>{_sentences(draw, 3)}</td><td>{_sentences(draw, 3)}</td></tr></table>",
                f"<figure><figcaption>{_sentences(draw, 9)}</figcaption></figure>",
                f"<div>{paragraph()}</div>", f"<section>{paragraph()}{paragraph()}</section>",
                f'<p>{_sentences(draw, 15)} <a href="#">{_sentences(draw, 3)}</a> {_sentences(draw, 15)}</p>',
            ]))
            if draw.random() < 0.12:
                parts.append(pick([advert, share, aside, form])())
        return "".join(parts)

    def main() -> str:
        return pick([
            lambda: f"<article data-main=1>{body()}</article>",
            lambda: f"<main data-main=1><article>{body()}</article></main>",
            lambda: f"<main data-main=1>{body()}</main>",
            lambda: f'<div {named("content main post entry article story body text page")} data-main=1>{body()}</div>',
            lambda: f'<div {named("content main post entry container wrapper")} data-main=1><div {named("post-body entry-content article-body text")}>{body()}</div></div>',
            lambda: f'<section {named("content article post story")} data-main=1>{body()}</section>',
            lambda: f"<div data-main=1>{body()}</div>",
        ])()

    pages = []
    for _ in range(n):
        before = [part() for part in (header, menu, notice, advert, form, aside) if draw.random() < 0.55]
        after = [part() for part in (comments, aside, advert, share, form, notice) if draw.random() < 0.45]
        draw.shuffle(before)
        parts = [*before, main(), *after, footer() if draw.random() < 0.9 else ""]
        inner = "".join(parts)
        if draw.random() < 0.3:
            inner = f'<div {named("page container wrapper site layout")}>{inner}</div>'
        pages.append(f"<html><head><title>{_sentences(draw, 4)}</title></head><body>{inner}</body></html>")
    return pages


@lru_cache(maxsize=1)
def default_model() -> TreeModel:
    return fit(labelled_pages())


def extract(html: str | None, model: TreeModel) -> str:
    """Blocks of the main text, joined by an empty line."""
    nodes = parse(html or "")
    keep = model.marginals(nodes, node_features(nodes))
    pieces = [(place, text) for node, p in zip(nodes, keep) if p >= 0.5 for place, text in node.texts]
    blocks: dict[int, list[str]] = {}
    for place, text in pieces:
        blocks.setdefault(place, []).append(text)
    joined = (SPACE.sub(" ", "".join(blocks[place])).strip() for place in sorted(blocks))
    return "\n\n".join(block for block in joined if block)


def extract_pages(df: DataFrame, model: TreeModel | None = None, html: str = "html") -> DataFrame:
    """``df`` without ``html``, with ``text`` and its length in code points, ``n_chars``."""
    model = model or default_model()
    others = [column for column in df.columns if column not in (html, "text", "n_chars")]
    kept = df.select(F.col(f"`{html}`").alias("_html"), *[F.col(f"`{column}`") for column in others])
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]] + ["text string, n_chars long"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html, model) for html in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*others, "text", "n_chars"],
            )

    return map_batches(kept, run, schema)
