"""Main text of web pages by a tree-structured graphical model.

A page's block elements and the runs of text between their borders are nodes of a tree. Every node is content or not; a node has a
potential from its features (tag, words of class, id and role, length, share of links), an edge one from the states of
parent and child. Messages go up from the leaves and down from the root (sum-product), which is exact on a tree and gives
each node's marginal. A run of text is kept when its marginal is over one half.

The potentials are trained from labelled pages: a sample of at most ``LABELLED`` pages, chosen by hash, whose own markup
says what is article and what is not. All other work covers every page.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimlathe.llm.common import pick

#: Pages that the model is trained on, at most.
LABELLED = 400
SMOOTHING = 1.0
#: Log odds of a name that says what it is and that the sample does not hold.
MEANT = -40.0
#: Most log odds that a tag, a length or a share of links can give, so that a short, listed or linked block in an article goes with its parent.
LIMIT = 0.8

# Names of HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title svg iframe object select textarea button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var br wbr img math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover semantics".split()
)
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
ARTICLE = frozenset("article main".split())
AROUND = frozenset("nav header footer aside form menu dialog".split())
AROUND_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments consent cookie disqus footer header menu modal nav "
    "navbar newsletter notice popup promo related replies share sidebar social sponsor sponsored subscribe toolbar widget".split()
)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_TAG = re.compile(r"<[A-Za-z/!?]")


class Node:
    __slots__ = ("tag", "words", "parent", "around", "text", "linked", "chars")

    def __init__(self, tag: str, words: frozenset, parent: int, within: bool = False):
        self.tag, self.words, self.parent = tag, words, parent
        self.around = within or tag in AROUND or not words.isdisjoint(AROUND_WORDS)
        self.text: list[str] | None = None
        self.linked = self.chars = 0


class Page(HTMLParser):
    """The block tree of a page, parents before children. Unclosed and stray tags are put right as browsers do for the
    usual cases: a block closes an open paragraph, an item the item before it, what may not stand in a head the head, and the end of a block
    what is hidden in it. A tag that the page ends in is left out."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", frozenset(), -1)]
        self.stack: list[tuple[str, int]] = [("html", 0)]
        self.hidden: list[str] = []
        self.links = 0
        self.run: Node | None = None
        self.open: Counter = Counter(["html"])
        ended = html.rfind(">") + 1  # nothing behind it is a whole tag; the parser would try each one up to the end
        cut = _TAG.search(html, ended)
        self.feed(html[: cut.start()] if cut else html)
        self.close()

    def handle_starttag(self, tag: str, attrs) -> None:
        if self.hidden:
            if self.hidden != ["head"] or tag in IN_HEAD:
                if tag not in VOID and tag not in INLINE:
                    self.hidden.append(tag)
                return
            self.hidden.clear()
        if tag in HIDDEN:
            self.hidden.append(tag)
            return
        if tag in INLINE:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "a":
                self.links += 1
            return
        self.run = None
        if tag in CLOSES_P:
            self.leave("p", within=None)
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
            alike = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(tag, (tag,))
            for other in alike:
                self.leave(other, within=("ul", "ol", "menu", "table", "dl", "tr") if tag != "tr" else ("table",))
        if tag == "hr" or tag in VOID or tag in ("html", "body") and len(self.stack) > 1 and tag == "html":
            return
        words = frozenset() if tag in ("html", "body") else frozenset(
            w for k, v in attrs if k in ("class", "id", "role", "aria-label") and v for w in _WORD.findall(v.lower())
        )
        parent = self.stack[-1][1]
        self.nodes.append(Node(tag, words, parent, self.nodes[parent].around))
        self.stack.append((tag, len(self.nodes) - 1))
        self.open[tag] += 1

    def cut(self, k: int) -> None:
        """Close the k-th open element and all within it."""
        self.open.subtract(name for name, _ in self.stack[k:])
        del self.stack[k:]

    def leave(self, tag: str, within: tuple | None) -> None:
        """Close the innermost ``tag`` unless one of ``within`` is open inside it."""
        for k in range(len(self.stack) - 1, 0, -1) if self.open[tag] else ():
            name = self.stack[k][0]
            if name == tag:
                self.cut(k)
                return
            if within is not None and name in within or within is None and name not in ("p",):
                return

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
                return
            if not self.open[tag]:
                return
            self.hidden.clear()
        if tag in INLINE:
            self.links -= tag == "a" and self.links > 0
            return
        self.run = None
        for k in range(len(self.stack) - 1, 0, -1) if self.open[tag] else ():
            if self.stack[k][0] == tag:
                self.cut(k)
                self.links = 0
                return

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.run is None:
            if not data.strip():
                return
            parent = self.stack[-1][1]
            self.run = Node("#text", frozenset(), parent, self.nodes[parent].around)
            self.run.text = []
            self.nodes.append(self.run)
        self.run.text.append(data)
        length = len(data.strip())
        self.run.chars += length
        self.run.linked += length * (self.links > 0)


def features(nodes: list[Node]) -> list[tuple]:
    """Per node: tag, words of its attributes that count, length class and link class of all text below it."""
    chars, linked = [n.chars for n in nodes], [n.linked for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        chars[nodes[k].parent] += chars[k]
        linked[nodes[k].parent] += linked[k]
    return [
        (("tag", n.tag), ("length", min(int(math.log2(c + 1)), 12)), ("links", round(4 * x / max(c, 1))))
        + tuple(("word", w) for w in sorted(n.words & AROUND_WORDS | n.words & ARTICLE))
        for n, c, x in zip(nodes, chars, linked, strict=True)
    ]


def labels(nodes: list[Node]) -> list[int] | None:
    """What the page's own markup says of its nodes: 1 within the article and in nothing that surrounds or interrupts articles. None
    where the page marks no article."""
    inside, out = [], []
    if not any(n.tag in ARTICLE or "main" in n.words for n in nodes):
        return None
    for n in nodes:
        up = inside[n.parent] if n.parent >= 0 else 0
        if n.tag in AROUND or n.words & AROUND_WORDS:
            up = -1
        elif up == 0 and (n.tag in ARTICLE or "main" in n.words):
            up = 1
        inside.append(up)
        out.append(int(up == 1))
    return out


class Model:
    """Log potentials: of a feature under each state, and of a child's state under its parent's, apart for children of what surrounds
    articles by name."""

    def __init__(self, pages: list[str]):
        counts, states, edges = Counter(), np.zeros(2), np.full((2, 2, 2), SMOOTHING)
        for html in pages:
            nodes = Page(html).nodes
            marked = labels(nodes)
            if marked is None:
                continue
            for n, y, fs in zip(nodes, marked, features(nodes), strict=True):
                states[y] += 1
                counts.update((f, y) for f in fs)
                if n.parent >= 0:
                    edges[int(nodes[n.parent].around), marked[n.parent], y] += 1
        if not states.any():  # no labelled page: what surrounds articles is known by name only
            for name in AROUND | AROUND_WORDS:
                counts[("tag" if name in AROUND else "word", name), 0] += 20
            for name in ARTICLE | {"p", "h1", "h2"}:
                counts[("tag", name), 1] += 20
            states += 400
            edges += np.array([[200, 20], [5, 400]])
        names = {f for f, _ in counts}
        self.weight = {
            f: tuple(math.log((counts[f, y] + SMOOTHING) / (states[y] + 2 * SMOOTHING)) for y in (0, 1)) for f in names
        }
        for f, (w0, w1) in self.weight.items():
            if f[0] != "word" and f[1] not in AROUND and f[1] not in ARTICLE:
                gap = min(max(w1 - w0, -LIMIT), LIMIT)
                self.weight[f] = (-gap / 2, gap / 2)
        for name in [("tag", n) for n in AROUND] + [("word", n) for n in AROUND_WORDS]:
            w0, w1 = self.weight.get(name, (0.0, MEANT))
            if w1 < w0:  # a name that the sample doesn't hold in articles keeps what it means
                self.weight[name] = (0.0, min(w1 - w0, MEANT))
        edge = np.log(edges / edges.sum(axis=2, keepdims=True))
        edge[1, 0, 1] = min(edge[1, 0, 1], MEANT / 4)
        self.edge = edge.tolist()

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of each node to be content: messages up, then down."""
        own = []
        for fs in features(nodes):
            a = b = 0.0
            for f in fs:
                w = self.weight.get(f)
                if w:
                    a, b = a + w[0], b + w[1]
            own.append([a, b])
        edge = [self.edge[nodes[n.parent].around] for n in nodes]

        def either(x: float, y: float) -> float:
            return x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))

        up = [None] * len(nodes)
        for k in range(len(nodes) - 1, 0, -1):  # own[k] holds the node's potential and all messages from below
            a, b = own[k]
            (e00, e01), (e10, e11) = edge[k]
            m = (either(e00 + a, e01 + b), either(e10 + a, e11 + b))
            up[k] = m
            parent = own[nodes[k].parent]
            parent[0] += m[0]
            parent[1] += m[1]
        out = [0.0] * len(nodes)
        for k, n in enumerate(nodes):  # parents first: own becomes the belief
            if n.parent >= 0:
                pa, pb = own[n.parent][0] - up[k][0], own[n.parent][1] - up[k][1]
                a, b = own[k]
                (e00, e01), (e10, e11) = edge[k]
                own[k] = [a + either(pa + e00, pb + e10), b + either(pa + e01, pb + e11)]
            a, b = own[k]
            out[k] = 1 / (1 + math.exp(min(max(a - b, -700), 700)))
        return out

    def text(self, html: str) -> str:
        nodes = Page(html).nodes
        likely = self.marginals(nodes)
        blocks = (
            _SPACE.sub(" ", "".join(n.text)).strip() for n, p in zip(nodes, likely, strict=True) if n.text is not None and p > 0.5
        )
        return "\n\n".join(b for b in blocks if b)


def train(pages: DataFrame, most: int = LABELLED) -> Model:
    """A model from ``most`` pages at most, the first by a hash of page_id. Only these reach the driver."""
    known = pick(pages, "page_id", "html").where("html IS NOT NULL AND html <> ''")
    # Ids first, so that tasks send no pages but the chosen ones.
    first = known.select("page_id", F.xxhash64("page_id").alias("h")).where("page_id IS NOT NULL").orderBy("h", "page_id").limit(most)
    chosen = sorted({row["page_id"] for row in first.collect()})
    sample = known.where(F.col("page_id").isin(chosen)).limit(most)
    return Model([row["html"] for row in sample.collect()])


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url and the main text of every page. A null html is empty and gives an empty text; repeated rows stay rows;
    other columns are left out; an empty table gives no rows. No shuffle."""
    model = model or train(pages)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "page_id": batch["page_id"].array, "url": batch["url"].array, "text": [model.text(h) for h in batch["html"]],
            })

    read = pick(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    return read.mapInPandas(work, "page_id long, url string, text string")


def op5_html_extract(spark, sf_dir: str) -> DataFrame:
    texts = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
