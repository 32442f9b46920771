"""Main text of web pages by minimum cut.

A page is cut into blocks of text at its block elements. A classifier gives each
block a cost, the capacity of its edge from the source (content) or to the sink
(boilerplate). It has two views. How a text looks (length, links, punctuation,
depth) is a logistic regression, fitted on blocks whose element
tells what they are: those of articles, and those of menus, footers and the like, in
a bounded sample of the pages. Where a block stands (in an article, in a menu, under
a name such as "advert") adds fixed weights. Neighbouring blocks, and blocks of one
parent, are tied by edges that weigh more the nearer they are in the document tree,
so a run of content carries a block that looks like none. The maximum flow
saturates the cheapest cut; what the source still reaches is the content.

Defined cases: null or empty html gives an empty text and 0 characters; a page
without tags, like any of a single block, is content unless that block stands in a
menu or the like; unclosed elements, comments and scripts end
with the page; equal pages have equal texts; without blocks to fit on the
look's weights are START; other columns than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .toxicity import logistic

# Elements of HTML and the words sites use for their parts.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACES = frozenset("br hr img wbr input".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog".split())
GOOD_TAGS = frozenset("article main".split())
BAD_WORDS = re.compile(r"(?:^|[\W_])(?:ads?|advert\w*|adverts?|banner|breadcrumbs?|comments?|consent|cookies?|copyright|disqus|footer|gdpr|header|masthead|menu|modal|nav\w*|newsletter|notice|notification|pagination|pager|popup|promo\w*|recommend\w*|related|replies|reply|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\W_])", re.IGNORECASE)
GOOD_WORDS = re.compile(r"(?:^|[\W_])(?:article|body|content|entry|main|post|story|text)(?:$|[\W_])", re.IGNORECASE)
NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|math|iframe|object|select|button|video|audio|canvas)\b[^<>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/<>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>"
    r"|<[!?/][^<>]*>",
    re.DOTALL | re.IGNORECASE,
)
#: Elements that a new one of the kind closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that an open paragraph does not outlast the start of.
ENDS_P = BLOCKS - {"body", "html", "head"}

#: Pages that the look is fitted on, at most.
MOST_PAGES = 500
#: What the look can say, either way, in natural logarithms of odds.
LOOK = 4.0
#: The look's weights where nothing can be fitted: of look().
START = (-2.0, 1.2, -4.0, 1.0, 0.0, 0.5)
#: Where a block stands: in an article, under a name of content, in a menu or the like, under a name of boilerplate (as a whole, in part), hidden.
IN_ARTICLE, GOOD_NAME, BAD_PLACE, BAD_NAME, BAD_PART, HIDDEN_COST = 2.5, 1.5, -8.0, -8.0, -4.0, -16.0
#: The tie of neighbours that are siblings, what divides it with each step more between them, the tie of blocks of one parent, and the distance beyond which all are equally far.
TIE, DECAY, SIBLING, FAR = 2.0, 4.0, 1.0, 8


@dataclass(slots=True)
class Element:
    tag: str
    depth: int
    parent: int
    #: What the places and names from the top down say.
    place: float
    #: 1 in an article, -1 in a menu or the like, 0 in neither or under a name of boilerplate.
    kind: int


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    tag: str
    element: int
    parent: int
    depth: int
    place: float
    kind: int


def place_of(tag: str, attributes: str, above: Element, in_article: bool) -> tuple[float, int]:
    """What an element adds to the place above it, and its kind."""
    place, kind = above.place, above.kind
    if attributes and HIDDEN.search(attributes):
        return place + HIDDEN_COST, 0
    if tag in BAD_TAGS or tag == "header" and not in_article:
        return min(place, 0.0) + BAD_PLACE, -1
    if tag in GOOD_TAGS:
        return max(place, place + IN_ARTICLE if kind < 1 else place), 1 if kind >= 0 else kind
    names = [n for m in NAMES.findall(attributes) for n in "".join(m).split()] if attributes and tag not in ("body", "html") else []
    if names:
        words = [[w for w in re.split(r"[\W_]+", n) if w] for n in names]
        bad = [sum(bool(BAD_WORDS.search(w)) for w in ws) / len(ws) for ws in words if ws]
        if bad and max(bad) > 0:
            return place + (BAD_NAME if max(bad) == 1 else BAD_PART), 0
        if any(GOOD_WORDS.search(n) for n in names) and place < IN_ARTICLE + GOOD_NAME:
            return place + GOOD_NAME, kind
    return place, kind


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The page's blocks of text in order, head and scripts left out; and its elements."""
    out: list[Block] = []
    elements = [Element("", 0, 0, 0.0, 0)]
    stack = [0]
    open_: Counter[str] = Counter()
    text: list[str] = []
    linked, links = 0, 0

    def close() -> None:
        nonlocal linked
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined and not open_["head"]:
                e = elements[stack[-1]]
                out.append(Block(joined, min(linked, len(joined)), e.tag, stack[-1], e.parent, e.depth, e.place, e.kind))
            text.clear()
        linked = 0

    def words(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if links:
            linked += len(piece.strip())

    def pop() -> str:
        tag = elements[stack.pop()].tag
        open_[tag] -= 1
        return tag

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            words(page[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1]:
                text.append(" ")
            continue
        ending, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        if tag == "a":
            links = max(0, links - 1) if ending else links + 1
        if tag in SPACES:
            text.append(" ")
        if tag not in BLOCKS:
            continue
        close()
        if tag in VOID:
            continue
        if ending:
            # only an open element is looked for, and what is passed is closed: the walk is linear
            if open_[tag]:
                while pop() != tag:
                    pass
                links = 0
            continue
        if tag in ENDS_P and elements[stack[-1]].tag == "p":
            pop()
        if tag == "body":
            while elements[stack[-1]].tag == "head":
                pop()
        while elements[stack[-1]].tag in CLOSES.get(tag, ()):
            pop()
        above = elements[stack[-1]]
        elements.append(Element(tag, above.depth + 1, stack[-1], *place_of(tag, attributes, above, open_["article"] + open_["main"] > 0)))
        stack.append(len(elements) - 1)
        open_[tag] += 1
    if at < len(page):
        rest = page[at:]
        words(rest[: rest.rfind("<")] if re.search(r"<[/!a-zA-Z][^>]*\Z", rest) else rest)
    close()
    return out, elements


def look(b: Block) -> list[float]:
    """How a block looks: bias, length, links, a sentence's end, depth, marks."""
    n = b.text.count(" ") + 1
    sentence = n >= 5 and b.text.rstrip("\"')”»")[-1:] in ".!?…"
    marks = sum(map(b.text.count, ",.;:"))
    return [1.0, np.log(n), b.linked / len(b.text), float(sentence), min(b.depth, 20) / 10, min(marks / n, 1.0)]


def score(b: Block, weights: np.ndarray) -> float:
    """The classifier: above 0 for content."""
    return float(np.clip(np.dot(look(b), weights), -LOOK, LOOK)) + b.place


def distance(a: int, b: int, elements: list[Element]) -> int:
    """Steps in the tree between two elements, FAR at most."""
    for steps in range(FAR):
        if a == b:
            return steps
        if elements[a].depth < elements[b].depth:
            a, b = b, a
        a = elements[a].parent
    return FAR


class Network:
    """A flow network with undirected ties; maximum flow by blocking flows in layers."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.head: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.out[a].append(len(self.head))
        self.out[b].append(len(self.head) + 1)
        self.head += [b, a]
        self.room += [there, back]

    def layers(self, source: int) -> list[int]:
        far = [-1] * len(self.out)
        far[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-9 and far[self.head[e]] < 0:
                    far[self.head[e]] = far[a] + 1
                    queue.append(self.head[e])
        return far

    def source_side(self, source: int, sink: int) -> list[bool]:
        """After the maximum flow: the nodes that the source still reaches."""
        while (far := self.layers(source))[sink] >= 0:
            tried = [0] * len(self.out)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    cut = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    a = self.head[path[cut] ^ 1]
                    del path[cut:]
                    continue
                for k in range(tried[a], len(self.out[a])):
                    e = self.out[a][k]
                    if self.room[e] > 1e-9 and far[self.head[e]] == far[a] + 1:
                        tried[a] = k
                        path.append(e)
                        a = self.head[e]
                        break
                else:
                    tried[a] = len(self.out[a])
                    if not path:
                        break
                    a = self.head[path.pop() ^ 1]
                    tried[a] += 1
        return [x >= 0 for x in far]


def content(found: list[Block], elements: list[Element], weights: np.ndarray) -> list[bool]:
    """Which blocks are content: the minimum cut."""
    n = len(found)
    net = Network(n + 2)
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        s = score(b, weights)
        if s > 0:
            net.edge(n, i, s)
        elif s < 0:
            net.edge(i, n + 1, -s)
        if i:
            tie = TIE / DECAY ** max(0, distance(found[i - 1].element, b.element, elements) - 2)
            net.edge(i - 1, i, tie, tie)
        before = last.get(b.parent)
        if before is not None and before < i - 1:
            net.edge(before, i, SIBLING / 2, SIBLING / 2)
        last[b.parent] = i
    return net.source_side(n, n + 1)[:n]


def main_text(page: str, weights: np.ndarray = np.array(START)) -> str:
    """The text of the content; a single block has no others to be told from and is content unless its place is a menu's or the like."""
    found, elements = blocks(page)
    if len(found) == 1 and found[0].place >= 0:
        return found[0].text
    return "\n\n".join(b.text for b, keep in zip(found, content(found, elements, weights), strict=True) if keep)


def fit(pages: DataFrame, most: int = MOST_PAGES) -> np.ndarray:
    """The look's weights, from the blocks of at most ``most`` pages whose element tells what they are."""
    texts = pages.select(F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    order = common.hash_order(F.col("html"))
    n = texts.count()
    near = F.pmod(order, F.lit(1_000_003)) < int(min(1.0, 2.0 * (most + 50) / max(n, 1)) * 1_000_003) + 1
    # (at most so many characters too: long pages are for the cut, not for fitting)
    sample = texts.where(near & (F.length("html") <= 200_000)).withColumn("order", order).orderBy("order", "html").limit(most)

    def run(batches):
        for pdf in batches:
            told = [(b.kind, look(b)) for page in pdf["html"] for b in blocks(page)[0] if b.kind]
            yield pd.DataFrame({"y": [float(k > 0) for k, _ in told], "x": pd.Series([x for _, x in told], dtype=object)})

    rows = sample.select("html").mapInPandas(run, "y double, x array<double>").toPandas()
    if not 0 < rows["y"].sum() < len(rows):
        return np.array(START)
    y, x = rows["y"].to_numpy(), np.stack(rows["x"].tolist())
    order = np.lexsort((*x.T, y))
    share = y.mean()
    # both kinds weigh the same, and no more than a few hundred blocks: few examples leave the weights near 0
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) * min(1.0, 300 / len(y))
    return logistic(x[order], y[order], weight[order], ridge=0.3)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""
    common.package_to_executors(pages.sparkSession)
    weights = fit(pages)

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, weights))

    out = pages.select("page_id", "url", texts(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
