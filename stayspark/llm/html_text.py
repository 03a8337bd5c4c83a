"""Main text of web pages by a minimum cut over their blocks.

A page is cut into blocks: text between the borders of block elements, without scripts, styles, comments and
the head. Each block has two costs, for calling it content and for calling it boilerplate, from its innermost
telling ancestor (element name, or words of class, id and role), its links, length and kind. Smoothness edges
tie blocks that follow each other, and every block to its parent element, which ties siblings together. The
costs are capacities from and to the two terminals; the minimum cut, by augmenting shortest paths, is the
labelling of least total cost. Before that, blocks whose costs outweigh all their edges are settled and passed
on to their neighbours, which no minimum cut would decide otherwise.

Null html is empty and gives an empty text, as does a page without content. Repeated rows are read each. A
broken page is read as far as it goes: open elements end with it, an element opened inside a paragraph that
cannot hold it ends the paragraph, a raw-text element without an end takes the rest.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=<))|<[!?][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-label)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
WORD = re.compile(r"[a-z]+")
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul button".split()
)
#: Elements and words of class, id and role that tell content (positive) or boilerplate.
ELEMENTS = {"nav": -8, "footer": -8, "aside": -7, "form": -7, "menu": -7, "dialog": -7, "button": -7, "select": -7, "search": -7, "article": 5, "main": 4}
OUTSIDE_ARTICLE = {"header": -7}
BAD_WORDS = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side footer cookie cookies consent notice notices alert comment comments disqus reply replies respond share sharing social related "
    "recommended newsletter subscribe subscription signup login search pagination pager popup modal copyright disclaimer legal widget toolbar "
    "contentinfo complementary masthead topbar hidden skip".split()
)
GOOD_WORDS = frozenset("article content post entry story main maincontent body".split())
UNIT = 10  # costs are whole numbers of a tenth
NEXT, PARENT = 1.5, 1.0


class Block:
    __slots__ = ("parts", "zone", "parent", "kind", "links", "container")

    def __init__(self, zone: float, parent: int, kind: str, container: int):
        self.parts, self.zone, self.parent, self.kind, self.links, self.container = [], zone, parent, kind, 0, container

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def zone_of(name: str, attributes: str, inherited: float, in_article: bool) -> float:
    """What an element says about its content, or else what its ancestors said."""
    if attributes:
        tokens: set[str] = set()
        for key, value in ATTRIBUTE.findall(attributes):
            if key.lower() == "hidden" and not value:
                return -8
            if key.lower() != "aria-label":
                tokens.update(WORD.findall(value.lower()))
        if name not in ("html", "body"):
            if tokens & BAD_WORDS:
                return -7
            if inherited > -5 and tokens & GOOD_WORDS:
                return 4
    told = ELEMENTS.get(name)
    if told is None and not in_article:
        told = OUTSIDE_ARTICLE.get(name)
    if told is None or (told > 0 and inherited <= -5):
        return inherited
    return told


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page with text in them, in order."""
    blocks: list[Block] = []
    # Open elements: name, zone, number, whether in an article.
    stack: list[tuple[str, float, int, bool]] = [("", 0.0, 0, False)]
    numbers, open_block, links, at, n = 0, None, 0, 0, len(page)
    head = False

    def put(text: str) -> None:
        nonlocal open_block
        if head or not text:
            return
        if open_block is None:
            if text.isspace():
                return
            holder = next(e for e in reversed(stack) if e[0] in BLOCK or e[2] == 0)
            above = next((e for e in reversed(stack[: stack.index(holder)]) if e[0] in BLOCK or e[2] == 0), stack[0])
            inner = min((e[1] for e in stack if e[1] <= -5), default=stack[-1][1])
            open_block = Block(stack[-1][1] if stack[-1][1] <= -5 else inner if inner <= -5 and stack[-1][1] <= 0 else stack[-1][1], above[2], holder[0], holder[2])
            blocks.append(open_block)
        open_block.parts.append(html.unescape(text))
        if links:
            open_block.links += len(text)

    while at < n:
        m = TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        if m.end() == m.start():
            put(page[at])
            at += 1
            continue
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in BLOCK:
                open_block = None
            if name == "head":
                head = False
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    links -= sum(e[0] == "a" for e in stack[i:])
                    del stack[i:]
                    break
                if name == "p" and stack[i][0] in BLOCK:
                    break
            continue
        if name in RAW:
            if name == "title" or not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{name}\s*>?", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if name == "br":
            put(" ")
            continue
        if name in BLOCK:
            open_block = None
            close = {"p"} | ({name} if name in ("li", "td", "th", "tr", "dt", "dd", "option") else set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in close:
                    links -= sum(e[0] == "a" for e in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in BLOCK:
                    break
        if name == "head":
            head = True
        elif name == "body":
            head = False
        if name in VOID or m[3].endswith("/"):
            continue
        numbers += 1
        _, zone, _, in_article = stack[-1]
        stack.append((name, zone_of(name, m[3], zone, in_article), numbers, in_article or name in ("article", "main")))
        links += name == "a"
    return [b for b in blocks if b.text()]


def lean(block: Block, text: str) -> float:
    """Cost of calling the block boilerplate less the cost of calling it content."""
    score = block.zone
    share = block.links / max(1, sum(map(len, block.parts)))
    if share > 0.5:
        score -= 4 * share
    words = text.count(" ") + 1
    if block.zone > -5:
        if block.kind in ("p", "pre", "blockquote", "li", "td", "dd", "figcaption"):
            score += 1
        if block.kind in ("h1", "h2", "h3"):
            score += 1.5
        if words >= 10:
            score += 2
        elif words < 4 and block.zone <= 0:
            score -= 1.5
        if text[-1] in ".!?:;\"'”»…":
            score += 0.5
        if block.zone <= 0 and text[:1] in "©":
            score -= 4
    return score


def minimum_cut(leans: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of least cost: node i pays |leans[i]| against its lean, an edge its weight if its ends differ."""
    n = len(leans)
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            around[a][b] = around[a].get(b, 0) + w
            around[b][a] = around[b].get(a, 0) + w
    leans, settled = list(leans), {}
    ready = deque(range(n))
    while ready:  # a node that outweighs its open edges takes its own side in some minimum cut
        i = ready.popleft()
        if i in settled or abs(leans[i]) < sum(around[i].values()):
            continue
        settled[i] = leans[i] > 0
        for j, w in around[i].items():
            leans[j] += w if settled[i] else -w
            around[j].pop(i, None)
            ready.append(j)
        around[i] = {}
    rest = [i for i in range(n) if i not in settled]
    if rest:
        source, sink = n, n + 1
        flow: dict[int, dict[int, int]] = {i: dict(around[i]) for i in rest} | {source: {}, sink: {}}
        for i in rest:
            if leans[i] > 0:
                flow[source][i], flow[i][source] = leans[i], 0
            elif leans[i] < 0:
                flow[i][sink], flow[sink][i] = -leans[i], 0
        while True:
            came, queue = {source: source}, deque([source])
            while queue and sink not in came:
                u = queue.popleft()
                for v, room in flow[u].items():
                    if room > 0 and v not in came:
                        came[v] = u
                        queue.append(v)
            if sink not in came:
                break
            path, v = [], sink
            while v != source:
                path.append((came[v], v))
                v = came[v]
            push = min(flow[u][v] for u, v in path)
            for u, v in path:
                flow[u][v] -= push
                flow[v][u] = flow[v].get(u, 0) + push
        for i in rest:
            settled[i] = i in came
    return [settled[i] for i in range(n)]


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    texts = [b.text() for b in blocks]
    leans = [round(UNIT * lean(b, t)) for b, t in zip(blocks, texts, strict=True)]
    n, edges, holders = len(blocks), [], {}
    for i in range(1, n):
        # Blocks that different elements tell apart are not held together.
        told_apart = (blocks[i].zone <= -5) != (blocks[i - 1].zone <= -5)
        edges.append((i - 1, i, round(UNIT * NEXT * (0.2 if told_apart else 1))))
    for i, b in enumerate(blocks):
        holder = holders.setdefault((b.parent, b.zone <= -5), n + len(holders))
        edges.append((i, holder, round(UNIT * PARENT)))
    labels = minimum_cut(leans + [0] * len(holders), edges)
    return "\n\n".join(t for t, content in zip(texts, labels, strict=False) if content)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(p) for p in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars bigint")
