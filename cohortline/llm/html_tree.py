"""Main-text extraction: a tree-structured graphical model over the DOM.

Every block element of a page is a variable with two states, content or not. Its features (tag, words of class and id, amount of
text, share of link text) give a node potential; a table of parent and child states gives the edge potentials. Messages
go up from the leaves and down from the root (sum-product, exact on a tree), and nodes whose content marginal is over a half
give the text. All weights are trained together, by gradient steps on the likelihood of labelled pages.
"""

from __future__ import annotations

import html
import math
import random
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import whole_text

# Names of HTML elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style title template noscript svg math iframe object select option textarea button canvas audio video".split())
RAW = frozenset("script style title textarea noscript iframe".split())
BLOCK = frozenset(
    "html body head address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "body", "head", "td", "th", "tr", "tbody", "thead", "tfoot"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl td th div section article body html main aside nav header footer form blockquote".split())

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>|"""
    r"""<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """A block element: its parent's place in the list, its tag and named words, and the characters of its own text."""

    parent: int
    tag: str
    names: tuple[str, ...]
    chars: int = 0
    linked: int = 0
    features: tuple[str, ...] = ()


@dataclass(slots=True)
class Page:
    """Nodes, parents before children, and segments of raw text (node, parts) in page order."""

    nodes: list[Node] = field(default_factory=list)
    segments: list[tuple[int, list[str]]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The block tree of a page; markup that isn't closed is closed as browsers do it, in the common cases."""
    page = Page([Node(-1, "root", ())])
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements and the node they belong to
    open_segment, links, unseen, at = None, 0, 0, 0

    def text(raw: str) -> None:
        nonlocal open_segment
        if unseen or not raw:
            return
        node = stack[-1][1]
        if open_segment is None or open_segment[0] != node:
            if raw.isspace():
                return
            open_segment = (node, [])
            page.segments.append(open_segment)
        open_segment[1].append(raw)
        n = len(raw) - raw.count(" ")
        page.nodes[node].chars += n
        page.nodes[node].linked += n if links else 0

    def pop() -> None:
        nonlocal open_segment, links, unseen
        name, _ = stack.pop()
        links -= name == "a"
        unseen -= name in UNSEEN
        if name in BLOCK:
            open_segment = None

    def close(names: set[str] | frozenset[str], stop: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in stop:
                return

    while True:
        m = TAG.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        if m["name"] is None:
            if m["cdata"]:
                text(html.escape(m["cdata"]))
            continue
        name = m["name"].lower()
        if m["close"]:
            if name == "br":
                text(" ")
            elif name in BLOCK:
                close({name}, frozenset() if name in ("body", "html") else SCOPE - {name} if name in SIBLINGS else frozenset())
            else:
                close({name}, BLOCK)
            continue
        if name in VOID:
            if name == "br":
                text(" ")
            elif name == "hr":
                open_segment = None
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if name in BLOCK:
            if name in CLOSES_P:
                close({"p"}, SCOPE)
            if name in SIBLINGS:
                close(SIBLINGS[name], SCOPE - SIBLINGS[name])
            found = [x for g in NAMED.findall(m["attrs"]) for x in g if x] if m["attrs"] else ()
            names = tuple(dict.fromkeys(w for x in found for w in WORD.findall(x.lower())))
            page.nodes.append(Node(stack[-1][1], name, names))
            stack.append((name, len(page.nodes) - 1))
            open_segment = None
        elif not m["attrs"].endswith("/"):
            stack.append((name, stack[-1][1]))
            links += name == "a"
            unseen += name in UNSEEN
    return page


def describe(page: Page) -> None:
    """Sets the features of each node."""
    for i, node in enumerate(page.nodes):
        size = "none" if not node.chars else str(min(5, int(math.log2(node.chars + 1)) // 2))
        linked = "none" if not node.chars else str(round(3 * node.linked / node.chars))
        node.features = ("bias", f"tag={node.tag}", f"size={size}", f"links={linked}", *(f"name={w}" for w in node.names))


@dataclass
class TreeModel:
    """Weights of features for the content state, and of edges (parent state, child state)."""

    weights: dict[str, float] = field(default_factory=dict)
    edges: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def marginals(self, nodes: list[Node]) -> tuple[list[float], list[tuple[float, float, float, float]]]:
        """P(content) of each node; for each node but the first P(parent, child) for (0,0), (0,1), (1,0), (1,1).

        Messages are log-odds. Lists have parents before children, so one pass from the end goes up, one from the start down."""
        get, exp, log = self.weights.get, math.exp, math.log
        (e00, e01), (e10, e11) = [[exp(x) for x in row] for row in self.edges]
        own = [sum(get(f, 0.0) for f in n.features) for n in nodes]
        up = own[:]  # node potential and messages of the children
        sent = [0.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            b = exp(max(-30.0, min(30.0, up[i])))
            sent[i] = log((b * e11 + e10) / (b * e01 + e00))
            up[nodes[i].parent] += sent[i]
        belief, pairs = up[:], [(0.0, 0.0, 0.0, 0.0)] * len(nodes)
        for i in range(1, len(nodes)):
            a = exp(max(-30.0, min(30.0, belief[nodes[i].parent] - sent[i])))
            belief[i] = up[i] + log((a * e11 + e01) / (a * e10 + e00))
            c = exp(max(-30.0, min(30.0, up[i])))
            p = (e00, c * e01, a * e10, a * c * e11)
            total = sum(p)
            pairs[i] = (p[0] / total, p[1] / total, p[2] / total, p[3] / total)
        return [1 / (1 + exp(-max(-30.0, min(30.0, x)))) for x in belief], pairs


def train(pages: list[tuple[list[Node], list[int]]], rounds: int = 12, rate: float = 0.3, decay: float = 1e-3) -> TreeModel:
    """Gradient steps (one a page, scaled by AdaGrad) on the likelihood of the labels."""
    model, seen = TreeModel(), {}

    def step(key, gradient: float, value: float) -> float:
        seen[key] = seen.get(key, 1e-2) + gradient * gradient
        return value + rate * gradient / math.sqrt(seen[key])

    for _ in range(rounds):
        for nodes, labels in pages:
            single, pairs = model.marginals(nodes)
            gradient: dict = {}
            for n, y, p in zip(nodes, labels, single):
                for f in n.features:
                    gradient[f] = gradient.get(f, 0.0) + y - p
            for i in range(1, len(nodes)):
                seen_pair = labels[nodes[i].parent] * 2 + labels[i]
                for k in range(4):
                    gradient[k] = gradient.get(k, 0.0) + (k == seen_pair) - pairs[i][k]
            for key, g in gradient.items():
                if isinstance(key, int):
                    row = model.edges[key // 2]
                    row[key % 2] = max(-6.0, min(6.0, step(key, g - decay * row[key % 2], row[key % 2])))
                else:
                    w = model.weights.get(key, 0.0)
                    model.weights[key] = step(key, g - decay * w, w)
    return model


# How the labelled pages name their parts.
CONTENT = "article main content post entry story body text single page".split()
OTHER = ("nav menu navbar navigation breadcrumb breadcrumbs header masthead topbar footer bottom copyright sidebar aside widget related "
         "recommended ad ads advert advertisement banner sponsor sponsored promo cookie cookies consent notice alert popup modal "
         "overlay newsletter subscribe signup form search login comment comments respond disqus reply share social pagination "
         "pager tags meta toolbar skip disclaimer").split()


def labelled_pages(count: int = 600, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Training pages with the label of each of their block elements, drawn from the ways such pages are built."""
    draw = random.Random(seed)

    def prose(n: int) -> str:
        return " ".join("w" * draw.randint(1, 9) for _ in range(n))

    def content(depth: int = 0) -> str:
        parts = [f"<h1 y=1>{prose(draw.randint(3, 14))}</h1>"] if draw.random() < 0.8 and not depth else []
        for _ in range(draw.randint(1, 9)):
            kind = draw.random()
            if kind < 0.68:
                inner = prose(draw.choice((1, 2, 4, 10, 30, 80)))
                inner = f"<b>{inner}" if draw.random() < 0.1 else f"{inner} <a href=x>{prose(2)}</a>" if draw.random() < 0.15 else inner
                parts.append(f"<p y=1>{inner}</p>")
            elif kind < 0.76:
                parts.append(f"<h2 y=1>{prose(4)}</h2>")
            elif kind < 0.82:
                parts.append("<ul y=1>" + "".join(f"<li y=1>{prose(draw.randint(1, 12))}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.87:
                parts.append(f"<blockquote y=1><p y=1>{prose(20)}</p></blockquote>")
            elif kind < 0.9:
                parts.append(f"<table y=1><tr y=1><td y=1>{prose(2)}</td><td y=1>{prose(2)}</td></tr></table>")
            elif kind < 0.93:
                parts.append(f"<pre y=1>{prose(9)}</pre><figure y=1><figcaption y=1>{prose(5)}</figcaption></figure>")
            elif kind < 0.96 and depth < 2:
                tag = draw.choice(("div", "section"))
                parts.append(f"<{tag} y=1>{content(depth + 1)}</{tag}>")
            else:
                parts.append(other())
        return "".join(parts)

    def other() -> str:
        tag = draw.choice(("div", "div", "div", "section", "nav", "header", "footer", "aside", "form", "ul"))
        named = f' class="{draw.choice(OTHER)}"' if tag in ("div", "section", "ul") or draw.random() < 0.3 else ""
        kind = draw.random()
        if tag == "ul" or kind < 0.3:
            items = "".join(f"<li y=0><a href=x>{prose(draw.randint(1, 4))}</a></li>" for _ in range(draw.randint(2, 8)))
            inner = items if tag == "ul" else f"<ul y=0>{items}</ul>"
        elif kind < 0.6:
            inner = prose(draw.choice((3, 8, 25, 60)))
        else:
            inner = "".join(f"<{t} y=0>{prose(draw.choice((2, 8, 25, 60)))}</{t}>" for t in draw.choices(("p", "div", "p", "h3", "li"), k=draw.randint(1, 4)))
        return f"<{tag} y=0{named}>{inner}</{tag}>"

    pages = []
    for _ in range(count):
        kind = draw.random()
        inner = content()
        if kind < 0.45:
            inner = f"<article y=1>{inner}</article>"
        elif kind < 0.6:
            inner = f"<main y=1>{inner}</main>"
        elif kind < 0.85:
            inner = f'<div y=1 class="{draw.choice(CONTENT)}">{inner}</div>'
        if draw.random() < 0.25:
            inner = f'<div y=1 id="{draw.choice(("wrapper", "container", "page", "main"))}">{inner}</div>'
        before, after = ("".join(other() for _ in range(draw.randint(0, 3))) for _ in range(2))
        source = f"<html y=1><head y=0></head><body y=1>{before}{inner}{after}</body></html>"
        if draw.random() < 0.3:  # pages that leave out what browsers add
            source = re.sub(r"<html y=1><head y=0></head><body y=1>|</body></html>", "", source)
        pages.append((re.sub(r" y=[01]", "", source), [1, *(int(y) for y in re.findall(r" y=([01])", source))]))
    return pages


def train_extractor(count: int = 600) -> TreeModel:
    """The model trained on labelled_pages; `count` bounds them."""
    examples = []
    for source, labels in labelled_pages(count):
        page = parse(source)
        describe(page)
        examples.append((page.nodes, labels))
    return train(examples)


def main_text(source: str, model: TreeModel) -> str:
    """Blocks of content in page order, one a line; white space inside a block is one space."""
    page = parse(source)
    describe(page)
    content = model.marginals(page.nodes)[0]
    blocks = (" ".join(html.unescape("".join(parts)).split()) for node, parts in page.segments if content[node] > 0.5)
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, model: TreeModel | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points): the main text of each row's whole html.

    A null or empty html, and one without content, gives an empty text. Repeated rows, null ids and null urls come back as they are; an empty
    table gives an empty result. Text without any markup is one block."""
    known = model or train_extractor()

    def run(batches):
        for b in batches:
            texts = [main_text(t.as_py(), known) for t in b["h"]]
            yield pa.RecordBatch.from_arrays([
                b["id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        whole_text(html_col).alias("h")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
