"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree. Each is content or not: what it shows
(words of its class, id and role, share of text in links, length of its own text)
depends on its own state, and its state on that of its parent, by tag. Sum-product
message passing, upward from the leaves and downward from the root, gives the
marginal of every element exactly; blocks of text whose element is content by it
are the text. The tables of the model are log counts over labelled pages: the
labelled layouts of ``html_examples`` and, where given, a bounded sample of pages
whose own landmarks (article, main, nav, ...) tell what is what.

A page is parsed and decided by itself, so the work is one pass over the table.

Defined cases: a null or empty html gives empty text. Broken markup is read as far
as it goes: missing end tags are closed by their parents, stray ones are skipped.
Repeated rows give the same text each. Null page_id and url are kept. Extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerbrook.llm import html_examples
from ledgerbrook.llm.common import first_by, keep

LABELLED_PAGES = 500
SMOOTHING = 0.5

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template iframe svg audio video select textarea button head title annotation annotation-xml".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr acronym nobr ruby rt rp picture source "
    "math mi mn mo ms mtext mspace mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mmultiscripts "
    "mprescripts mstyle mpadded mphantom menclose merror mtable mtr mtd semantics".split()
)
CLOSED_BY_LIKE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}}

_HIDDEN = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element, or the page at the root: its look, its children and its own runs of text."""

    __slots__ = ("tag", "hints", "parent", "children", "length", "linked", "own", "label")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]], parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.length = self.linked = self.own = 0
        self.label: bool | None = None
        words: set[str] = set()
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                words.update(w.lower() for w in _WORD.findall(value))
            elif name == "hidden" or (name == "style" and value and _HIDDEN.search(value)):
                words.add("hidden")
            elif name == "data-keep":
                self.label = value != "0"
        self.hints = words
        if parent is not None:
            parent.children.append(self)


class Page(HTMLParser):
    """Nodes in page order, and the runs of text as (node, text)."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("page", [], None)
        self.nodes, self.blocks = [self.root], []
        self.open: list[tuple[str, Node]] = [("page", self.root)]
        # how many elements of a name are open: an end tag without one is passed over at once
        self.held: Counter[str] = Counter()
        self.run: list[str] = []
        self.silent = self.links = self.link_chars = 0
        self.feed(html)
        self.close()
        self.flush()
        for node in reversed(self.nodes):
            if node.parent is not None:
                node.parent.length += node.length
                node.parent.linked += node.linked

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            node = self.open[-1][1]
            node.own += len(text)
            node.length += len(text)
            node.linked += min(self.link_chars, len(text))
            self.blocks.append((node, text))
        self.run, self.link_chars = [], 0

    def pop(self) -> None:
        self.flush()
        self.held[self.open.pop()[0]] -= 1
        self.links = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("body", "article", "main"):
            # a head or button that never ends does not swallow the page
            self.silent = 0
        if self.silent or tag in SILENT:
            # text of these never shows; only their own nesting is counted
            self.silent += tag in SILENT and tag not in VOID
            return
        if tag in INLINE or tag in VOID:
            if tag in ("br", "img", "hr", "input"):
                self.run.append(" ")
            self.links += tag == "a"
            if tag == "hr":
                self.flush()
            return
        if tag in ("html", "body") and len(self.open) == 1:
            self.root.hints |= Node(tag, attrs, None).hints
            return
        self.flush()
        self.links = 0
        while self.open[-1][0] == "p":
            self.pop()
        like = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
        if tag in CLOSED_BY_LIKE and any(self.held[name] for name in like):
            for back in range(len(self.open) - 1, 0, -1):
                name = self.open[back][0]
                if name in CLOSED_BY_LIKE[tag]:
                    break
                if name in like:
                    while len(self.open) > back:
                        self.pop()
                    break
        node = Node(tag, attrs, self.open[-1][1])
        self.nodes.append(node)
        self.open.append((tag, node))
        self.held[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag not in SILENT:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
            return
        if self.silent:
            return
        if tag in INLINE:
            if tag == "a":
                self.links = max(0, self.links - 1)
            return
        if self.held[tag]:
            while self.open[-1][0] != tag:
                self.pop()
            self.pop()

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.run.append(data)
        if self.links:
            self.link_chars += len(data.strip())


def looks(node: Node) -> list[str]:
    """What a node shows, as names of observations."""
    share = node.linked / node.length if node.length else -1.0
    link = "none" if share < 0 else "0" if share == 0 else "low" if share < 0.3 else "mid" if share < 0.7 else "high"
    own = "0" if not node.own else "s" if node.own < 40 else "m" if node.own < 160 else "l"
    return [f"link={link}", f"own={own}", *(f"hint={h}" for h in sorted(node.hints))]


def label_by_landmarks(page: Page) -> bool:
    """Set the labels of a page by its own landmarks; False if it has none to go by."""
    kept = [n for n in page.nodes if n.tag in ("article", "main")]
    if not kept:
        return False
    for node in page.nodes:
        above = node.parent.label if node.parent else False
        if node.tag in ("nav", "footer", "aside", "form", "dialog"):
            node.label = False
        elif node.tag in ("article", "main"):
            node.label = True
        else:
            node.label = bool(above)
    return True


def label_by_marks(page: Page) -> None:
    """Labels from data-keep marks, inherited by what stands below."""
    for node in page.nodes:
        if node.label is None:
            node.label = node.parent.label if node.parent else False


def counts(page: Page) -> Counter:
    """Counts (kind, name, state) that the tables are made of."""
    out: Counter = Counter()
    for node in page.nodes:
        state = int(node.label)
        out["state", "", state] += 1
        for name in looks(node):
            out["look", name, state] += 1
        if node.parent is not None:
            above = int(node.parent.label)
            out["edge", str(above), state] += 1
            out["edge", f"{above}{node.tag}", state] += 1
    return out


class Model:
    """Log potentials: of each observation by state, and of each state by that of the parent and the own tag."""

    def __init__(self, found: Counter) -> None:
        total = [found["state", "", s] for s in (0, 1)]
        names = {name for kind, name, _ in found if kind == "look"}
        self.looks = {
            n: tuple(math.log((found["look", n, s] + SMOOTHING) / (total[s] + 2 * SMOOTHING)) for s in (0, 1)) for n in names
        }

        def share(name: str, state: int, prior: float) -> float:
            n = [found["edge", name, s] for s in (0, 1)]
            return (n[state] + 2 * prior) / (sum(n) + 2)

        plain = [[share(str(p), s, 0.5) for s in (0, 1)] for p in (0, 1)]
        tags = {name[1:] for kind, name, _ in found if kind == "edge"}
        # a tag without counts of its own takes those of all tags
        self.edges = {
            t: [[math.log(share(f"{p}{t}", s, plain[p][s])) for s in (0, 1)] for p in (0, 1)] for t in tags
        }
        self.edges[""] = [[math.log(plain[p][s]) for s in (0, 1)] for p in (0, 1)]

    def edge(self, node: Node) -> list[list[float]]:
        return self.edges.get(node.tag) or self.edges[""]

    def marginals(self, page: Page) -> dict[Node, float]:
        """The probability of being content of every node."""
        up: dict[Node, list[float]] = {}
        sent: dict[Node, list[float]] = {}
        # the page itself is no content; what it holds may be
        for node in page.nodes:
            seen = [self.looks[n] for n in looks(node) if n in self.looks]
            up[node] = [sum(x[0] for x in seen), sum(x[1] for x in seen)]
        up[page.root][1] -= 50.0
        for node in reversed(page.nodes):
            if node.parent is not None:
                own, e = up[node], self.edge(node)
                sent[node] = message = [_log_sum(e[p][0] + own[0], e[p][1] + own[1]) for p in (0, 1)]
                above = up[node.parent]
                above[0] += message[0]
                above[1] += message[1]
        down: dict[Node, list[float]] = {page.root: [0.0, 0.0]}
        out: dict[Node, float] = {}
        for node in page.nodes:
            if node.parent is not None:
                above, back, from_up, e = up[node.parent], sent[node], down[node.parent], self.edge(node)
                rest = [above[p] + from_up[p] - back[p] for p in (0, 1)]
                down[node] = [_log_sum(rest[0] + e[0][s], rest[1] + e[1][s]) for s in (0, 1)]
            belief = [up[node][s] + down[node][s] for s in (0, 1)]
            out[node] = 1 / (1 + math.exp(min(700.0, max(-700.0, belief[0] - belief[1]))))
        return out

    def text(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        content = self.marginals(page)
        return "\n".join(text for node, text in page.blocks if content[node] >= 0.5)


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def _page_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for html in batch.column(0).to_pylist():
            page = Page(html)
            if label_by_landmarks(page):
                total.update(counts(page))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in total], pa.string()),
            pa.array([k[1] for k in total], pa.string()),
            pa.array([k[2] for k in total], pa.int64()),
            pa.array(list(total.values()), pa.int64()),
        ],
        names=["kind", "name", "state", "n"],
    )


def fit(pages: DataFrame | None = None, limit: int = LABELLED_PAGES) -> Model:
    """Model from the labelled layouts and at most ``limit`` pages with landmarks, the first by a hash of their html."""
    total: Counter = Counter()
    for html in html_examples.pages():
        page = Page(html)
        label_by_marks(page)
        total.update(counts(page))
    if pages is not None:
        rows = pages.where("html IS NOT NULL").where(F.col("html").rlike("(?i)<(article|main)[ >]"))
        rows = first_by(rows.select("html"), F.xxhash64("html"), limit)
        found = keep(rows, "labelled").mapInArrow(_page_counts, "kind string, name string, state long, n long")
        # names come from at most ``limit`` pages
        for row in found.groupBy("kind", "name", "state").agg(F.sum("n").alias("n")).where("n > 2").collect():
            total[row["kind"], row["name"], row["state"]] += row["n"]
    return Model(total)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    held = pages.sparkSession.sparkContext.broadcast(model or fit(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [held.value.text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
