"""Main text of web pages by minimum cut.

A page is read into blocks: the text between borders of block-level elements, with white space as one space. A linear classifier prices both labels
of each block by its own text: length, share of link text, sentence marks, words, heading, depth. It is fitted (``fit``) on at most ``FIT_PAGES``
pages, where blocks in elements that name themselves, such as ``article`` or ``nav``, are the examples; prices become capacities to the two terminals.

Smoothness edges join blocks next to each other, more the closer they stand in the tree, and each block with the nearest element around it that
names itself. Elements whose tag, role or whole class name says what they are belong to a terminal; those with a word of a name only (``related-work``,
``widget-body``) have a small price and are pulled by the element around them. Blocks with no such element around have a small
preference for content. The minimum cut separates content from boilerplate; content keeps page order, joined by two newlines.

Work is in proportion to the page: elements point to their parents, and the distance of neighbours is read off the lowest depth between them.

Scripts, styles, templates, hidden elements, comments of the markup and the head are not text. Null, empty and malformed pages give
what text can be read, at least the empty string. Nothing is cut off. Rows repeat as they stand; without examples of both kinds stated weights price the blocks.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
SILENT_TAGS = frozenset("head script style template noscript svg math iframe object embed canvas audio video map title button select textarea datalist".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": BLOCK_TAGS - {"html", "body", "option", "optgroup"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset legend search".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline captcha comment comments commentlist consent cookie cookies copyright "
    "disclaimer disqus dropdown feedback footer gdpr header login masthead menu menubar meta modal nav navbar navigation newsletter notice notices notification pager pagination "
    "paging popup popular privacy promo promoted promotion reaction reactions recommended related replies reply respond rss share sharing shoutbox sidebar signin signup skip "
    "social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar widget".split()
)
PLAIN_NAMES = frozenset("ad ads adv advert advertisement banner breadcrumb comment comments cookie cookies disqus footer menu nav navbar newsletter pager pagination share sidebar social sponsor sponsored subscribe".split())
BOILERPLATE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CONTENT_TAGS = frozenset(["article", "main"])
CONTENT_NAMES = frozenset("article content entry post story body main text".split())
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"[\s\x00]+")
_CUT_OFF = re.compile(r"</?[a-zA-Z][^<>]*\Z")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

FEATURES = ("bias", "length", "links", "sentence", "heading", "depth")
WEIGHTS = (-0.6, 1.5, -4.0, 0.4, 0.4, 0.0)
"""Stated weights, where no pages are given to fit on."""

FIT_PAGES, FIT_BLOCKS, FIT_ROUNDS, FIT_SHRINK = 2_000, 100_000, 200, 0.01
PRICE_LIMIT = (-4.0, 1.5)
NEAR, ADJACENT, UNMARKED, PARTLY = 4.0, 3.0, 1.0, 1.5
"""Capacities: to the element around, to the next block, the preference of blocks without one, and the price of a partial name."""


class Block:
    """A stretch of text, where it stands, and the nearest element that names itself."""

    __slots__ = ("depth", "heading", "links", "low", "mark", "parent", "text")

    def __init__(self, text: str, links: int, depth: int, low: int, parent: int, mark: int, heading: bool):
        self.text, self.links, self.depth, self.low, self.parent, self.mark, self.heading = text, links, depth, low, parent, mark, heading


class Mark:
    """An element that names itself: its price (infinite if it says what it is), its depth, and the next such element around."""

    __slots__ = ("around", "depth", "price")

    def __init__(self, price: float, depth: int, around: int):
        self.price, self.depth, self.around = price, depth, around


SURE = float("inf")


def _named(given: dict[str, str]) -> tuple[bool, bool, bool]:
    """Whether class or id have a whole name of boilerplate, a part of one, and a name of content."""
    whole = part = content = False
    for token in f"{given.get('class', '')} {given.get('id', '')}".split():
        words_ = _WORD.findall(token)
        hits = sum(w in BOILERPLATE_NAMES for w in words_)
        # ad-slot-3, cookie-bar and comments-list say what they are by their first word; related-work and widget-body do not
        whole |= bool(hits) and (hits == len(words_) or words_[0] in PLAIN_NAMES)
        part |= bool(hits)
        content |= any(w in CONTENT_NAMES for w in words_)
    return whole and not content, part, content


class _Reader(HTMLParser):
    """Blocks of a page, and the elements that name themselves."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.marks: list[Mark] = []
        # tag, number, block-level elements up to it, nearest mark, number of the innermost block-level element
        self.open: list[tuple[str, int, int, int, int]] = [("", 0, 0, -1, 0)]
        self.named: Counter = Counter()
        self.count, self.silent, self.in_link, self.headings, self.low = 0, 0, 0, 0, 0
        self.parts: list[str] = []
        self.linked = 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            if tag in ("br", "hr", "wbr", "img", "input"):
                self.flush() if tag == "hr" else self.parts.append("" if tag == "wbr" else " ")
            return
        if tag in BLOCK_TAGS:
            self.flush()
            while len(self.open) > 1 and tag in CLOSED_BY.get(self.open[-1][0], ()):
                self.pop()
        self.count += 1
        given = {k: (v or "").lower() for k, v in attrs}
        _, _, depth, mark, parent = self.open[-1]
        if tag in BLOCK_TAGS:
            depth, parent = depth + 1, self.count
        price = self._price(tag, given, mark)
        if price:
            self.marks.append(Mark(price, depth, mark))
            mark = len(self.marks) - 1
        silent = tag in SILENT_TAGS or "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style", "")))
        self.open.append((f"!{tag}" if silent else tag, self.count, depth, mark, parent))
        self.named[tag] += 1
        self.silent += silent
        self.in_link += tag == "a"
        self.headings += _is_heading(tag)

    def _price(self, tag: str, given: dict[str, str], around: int) -> float:
        """The price of an element by what it calls itself; 0 if it says nothing."""
        role = given.get("role", "")
        top = tag in ("html", "body") or tag in CONTENT_TAGS
        whole, part, content = (False, False, False) if top else _named(given)
        in_content = around >= 0 and self.marks[around].price > 0
        if tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or (tag == "header" and not in_content) or whole:
            return -SURE
        if tag in CONTENT_TAGS or role in ("main", "article") or given.get("itemprop") == "articlebody":
            # an article within comments or a sidebar is one of theirs
            return -SURE if around >= 0 and self.marks[around].price == -SURE else SURE
        return (PARTLY if content else 0.0) - (PARTLY if part else 0.0) or (-0.1 if part else 0.0)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag in ("script", "style", "svg", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.named[tag]:
            if tag in ("br", "p"):
                self.flush() if tag == "p" else self.parts.append(" ")
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0].lstrip("!")
            if name == tag:
                if any(e[0].lstrip("!") in BLOCK_TAGS for e in self.open[at:]):
                    self.flush()
                while len(self.open) > at:
                    self.pop()
                return
            if tag not in BLOCK_TAGS and name in BLOCK_TAGS and tag not in SILENT_TAGS:
                return  # a stray end of an inline element does not close a block

    def pop(self):
        tag = self.open.pop()[0]
        name = tag.lstrip("!")
        self.named[name] -= 1
        self.silent -= tag.startswith("!")
        self.in_link -= name == "a"
        self.headings -= _is_heading(name)
        self.low = min(self.low, self.open[-1][2])

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data)

    def flush(self):
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            _, _, depth, mark, parent = self.open[-1]
            self.blocks.append(Block(text, min(self.linked, len(text)), depth, min(self.low, depth), parent, mark, self.headings > 0))
            self.low = depth
        self.parts, self.linked = [], 0


def _is_heading(tag: str) -> bool:
    return len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()


def read_page(html: str) -> tuple[list[Block], list[Mark]]:
    reader = _Reader()
    reader.feed(_CUT_OFF.sub("", html))
    reader.close()
    reader.flush()
    return reader.blocks, reader.marks


def features(block: Block) -> tuple[float, ...]:
    """What the text of a block says by itself, each between 0 and 1."""
    words_ = block.text.count(" ") + 1
    return (1.0, min(words_, 40) / 40, block.links / len(block.text), float(block.text[-1] in ".!?:;。！？"), float(block.heading), min(block.depth, 12) / 12)


def price(block: Block, weights: Sequence[float] = WEIGHTS) -> float:
    """How much better the text fits content than boilerplate."""
    return min(max(sum(w * f for w, f in zip(weights, features(block), strict=True)), PRICE_LIMIT[0]), PRICE_LIMIT[1])


def fit(pages: DataFrame) -> tuple[float, ...]:
    """Weights of the features by logistic regression, from the blocks of at most ``FIT_PAGES`` pages whose elements say what they are.

    Pages are drawn by a hash of their row, in equal shares of all parts of the table, so that only the sample is moved. Both kinds weigh
    alike. Without examples of both the stated weights stay.
    """
    own = [c for c in ("page_id", "url", "html") if c in pages.columns]
    chance = F.shiftrightunsigned(F.xxhash64(*own), 11).cast("double") / F.lit(float(1 << 53))
    drawn = pages.where((F.col("html") != "") & (chance * pages.count() < FIT_PAGES))
    sample = drawn.select(F.col("html").cast("string").alias("html")).limit(FIT_PAGES)

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for html in batch["html"]:
                blocks, marks = read_page(html)
                sure = [(*features(b), float(marks[b.mark].price > 0)) for b in blocks if b.mark >= 0 and abs(marks[b.mark].price) == SURE]
                yield pd.DataFrame(sure, columns=[*FEATURES, "label"], dtype=float)

    columns = ", ".join(f"{c} double" for c in (*FEATURES, "label"))
    rows = sample.repartition(8).mapInPandas(examples, columns).limit(FIT_BLOCKS).toPandas()
    x, y = rows[list(FEATURES)].to_numpy(), rows["label"].to_numpy()
    if not 0 < y.sum() < len(y):
        return WEIGHTS
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w = np.zeros(x.shape[1])
    for _ in range(FIT_ROUNDS):
        p = 1 / (1 + np.exp(-x @ w))
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + FIT_SHRINK * np.eye(len(w))
        step = np.linalg.solve(curve, x.T @ (share * (y - p)) - FIT_SHRINK * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def graph(blocks: list[Block], marks: list[Mark], weights: Sequence[float] = WEIGHTS) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Prices of all blocks and then of all marks, and the edges between them."""
    n = len(blocks)
    prices = [price(b, weights) + (UNMARKED if b.mark < 0 else 0.0) for b in blocks] + [m.price for m in marks]
    edges, latest = [], {}
    for i, block in enumerate(blocks):
        if i:
            apart = block.depth + blocks[i - 1].depth - 2 * block.low
            edges.append((i - 1, i, ADJACENT / (1 + apart)))
        if latest.get(block.parent, i - 1) != i - 1:
            edges.append((latest[block.parent], i, ADJACENT / 3))
        latest[block.parent] = i
        if block.mark >= 0:
            edges.append((i, n + block.mark, NEAR / (1 + 0.25 * (block.depth - marks[block.mark].depth))))
    for j, mark in enumerate(marks):
        if mark.around >= 0 and abs(mark.price) != SURE:
            edges.append((n + j, n + mark.around, NEAR / (1 + 0.25 * (mark.depth - marks[mark.around].depth))))
    return prices, edges


def min_cut(prices: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the content terminal when the cheapest cut is made (maximum flow by shortest augmenting paths).

    A node which no edges could outweigh is settled at once and joins its terminal, which settles others in turn; the flow runs over the rest.
    """
    label, settled = settle(prices, edges)
    n = len(prices)
    if all(settled):
        return label
    source, sink = n, n + 1
    near: dict[int, dict[int, float]] = {v: {} for v in (source, sink)}

    def add(a: int, b: int, forth: float, back: float) -> None:
        one, two = near.setdefault(a, {}), near.setdefault(b, {})
        one[b] = one.get(b, 0.0) + forth
        two[a] = two.get(a, 0.0) + back

    for v, p in enumerate(prices):
        if not settled[v]:
            add(source, v, max(p, 0.0), 0.0)
            add(v, sink, max(-p, 0.0), 0.0)
    for a, b, c in edges:
        if settled[a] and settled[b]:
            continue
        if settled[a] or settled[b]:
            fixed, free = (a, b) if settled[a] else (b, a)
            add(source, free, c, 0.0) if label[fixed] else add(free, sink, c, 0.0)
        else:
            add(a, b, c, c)
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            v = queue.popleft()
            for w, c in near[v].items():
                if c > 1e-12 and w not in came:
                    came[w] = v
                    queue.append(w)
        if sink not in came:
            return [label[v] if settled[v] else v in came for v in range(n)]
        way, v = [], sink
        while v != source:
            way.append((came[v], v))
            v = came[v]
        flow = min(near[a][b] for a, b in way)
        for a, b in way:
            near[a][b] -= flow
            near[b][a] += flow


def settle(prices: list[float], edges: list[tuple[int, int, float]]) -> tuple[list[bool], list[bool]]:
    """Labels by price, and which of them no flow can change: a node whose price, with the edges to settled nodes, outweighs all its other edges."""
    n = len(prices)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    pull = [0.0] * n
    for a, b, c in edges:
        near[a].append((b, c))
        near[b].append((a, c))
        pull[a] += c
        pull[b] += c
    own, label, settled = list(prices), [p > 0 for p in prices], [False] * n
    queue = deque(v for v in range(n) if abs(own[v]) >= pull[v])
    while queue:
        v = queue.popleft()
        if settled[v]:
            continue
        settled[v], label[v] = True, own[v] > 0
        for w, c in near[v]:
            if not settled[w]:
                pull[w] -= c
                own[w] += c if label[v] else -c
                if abs(own[w]) >= pull[w] + 1e-9:
                    queue.append(w)
    return label, settled


def labels(html: str, weights: Sequence[float] = WEIGHTS) -> tuple[list[Block], list[bool], dict[str, int]]:
    """The blocks of a page, which are content, and how many there are, how many their own price does not decide, are left to the flow when
    settled neighbours have been counted in, and have another label by the cut than by their price."""
    blocks, marks = read_page(html)
    prices, edges = graph(blocks, marks, weights)
    keep = min_cut(prices, edges)[: len(blocks)]
    settled = settle(prices, edges)[1]
    pull = [0.0] * len(prices)
    for a, b, c in edges:
        pull[a] += c
        pull[b] += c
    undecided = sum(abs(p) < s for p, s in zip(prices[: len(blocks)], pull, strict=False))
    changed = sum((p > 0) != k for p, k in zip(prices, keep, strict=False))
    return blocks, keep, {"blocks": len(blocks), "undecided": undecided, "in_flow": len(blocks) - sum(settled[: len(blocks)]), "changed": changed}


def main_text(html: str | None, weights: Sequence[float] = WEIGHTS) -> str:
    if not html:
        return ""
    blocks, marks = read_page(html)
    keep = min_cut(*graph(blocks, marks, weights))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=False) if k)


def _extract(weights: Sequence[float]) -> Callable:
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[main_text(h, weights) for h in batch["html"]]).drop(columns="html")

    return extract


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), weights: Sequence[float] | None = None) -> DataFrame:
    """Every page's ``keep`` columns with text and n_chars (code points). Without ``weights`` they are fitted on the pages."""
    weights = fit(pages) if weights is None else weights
    rows = pages.select(*keep, F.col("html").cast("string").alias("html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    text = rows.mapInPandas(_extract(weights), f"{kinds}, text string")
    return text.withColumn("n_chars", F.char_length("text").cast("long"))
