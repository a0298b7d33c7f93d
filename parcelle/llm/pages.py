"""Main text of web pages by minimum-cut labelling of text blocks.

A page becomes a row of text blocks. A linear classifier gives each block a
cost of calling it content and one of calling it boilerplate; these are its
capacities to the two terminals. Neighbouring blocks, and blocks under one
parent, are tied by smoothness edges. The minimum cut, found by maximum flow,
is the cheapest labelling as a whole.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|object|select|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(!\[CDATA\[)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(?:((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)|([^>]*)(?:>|\Z))",
    re.S | re.I,
)
#: What ends a part whose text is taken or dropped as a whole; without an end the opening is like any other markup.
_ENDS = {"title": re.compile(r"</title\s*>", re.I), "cdata": re.compile(r"\]\]>")}
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HINTS = frozenset(("class", "id", "role"))
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?…:;,](?:\s|$)")

#: Tags; fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub"
    " sup time tt u var wbr".split())
MATH = frozenset(
    "annotation annotation-xml maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms"
    " mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
INLINE |= MATH
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " li main menu nav ol p pre section table tbody td th thead tr ul".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section div main body nav aside header footer form".split())

#: Weights of the classifier, in units of log odds for content. Region weights count once per block, for the nearest region.
BOILER_TAGS = frozenset("nav footer aside form button menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = re.compile(
    r"(?:^|[\s_-])(ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|nav(?:igation|bar)?|menu|breadcrumbs?|footer|"
    r"header|masthead|sidebar|side|rail|widget|related|recommend(?:ed|ations)?|share|sharing|social|cookies?|consent|notice|gdpr|popup|modal|"
    r"newsletter|subscribe|subscription|signup|login|search|comments?|comment-list|replies|reply|disqus|discussion|pager|pagination|legal|"
    r"copyright|toolbar|skip|tags|toc)(?=$|[\s_-])", re.I)
#: Of these, the words that also name parts of an article; below content they only take back the region's weight.
UNSURE_WORDS = frozenset("side header rail share sharing search replies reply discussion legal copyright skip tags toc promotion promotions".split())
CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:article|post|entry|content|main|body|story|text)(?:$|[\s_-])", re.I)
BIAS, PER_WORD, MOST_WORDS, PER_LINK, PER_SENTENCE = -0.6, 0.05, 40, -4.0, 1.0
HEADING, ITEM, REGION, WORDS = 0.6, -0.8, 6.0, 4.0
ADJACENT, SIBLING, DISTANT = 0.8, 0.6, 0.15


def is_hidden(pairs: list[tuple[str, str]]) -> bool:
    """True by the attributes' names, or by the values of aria-hidden and style; words in other values do not count."""
    return any(
        name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NO_DISPLAY.search(value)
        for name, value in pairs)


@dataclass
class Block:
    text: str
    link: float
    tag: str
    parent: int
    outer: int
    region: float


class Open:
    """The open elements: (tag, region, hidden, open links), with the places of each tag and a list of the containers.

    Each question takes a time that does not depend on the depth.
    """

    def __init__(self):
        self.stack: list[tuple[str, float, bool, int]] = [("body", 0.0, False, 0)]
        self.boxes: list[tuple[str, float, int]] = [("body", 0.0, 0)]  # tag, region, number
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, region: float, number: int, hidden: bool, links: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, region, hidden, links))
        if tag not in INLINE:
            self.boxes.append((tag, region, number))

    def cut(self, upto: int) -> None:
        while len(self.stack) > upto:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag not in INLINE:
                self.boxes.pop()

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag, 0 if there is none."""
        return (self.places.get(tag) or (0,))[-1]

    def within(self, names: tuple[str, ...], scope: frozenset[str]) -> int:
        """The innermost place of the names, 0 if there is none or an element of the scope is open inside it."""
        place = max(map(self.last, names))
        return place if place and all(self.last(t) <= place for t in scope) else 0

    def holds_container(self, upto: int) -> bool:
        return any(self.stack[i][0] not in INLINE for i in range(upto, len(self.stack)))


def hint(name: str, words: str, region: float) -> float:
    """Region of an element, given the words of its class, id and role and the region without them."""
    found = {w.lower() for w in BOILER_WORDS.findall(words)}
    if found and name not in CONTENT_TAGS:
        return 0.0 if region > 0 and found <= UNSURE_WORDS else min(region, -WORDS)
    return WORDS if not found and region == 0 and CONTENT_WORDS.search(words) else region


def blocks(page: str) -> list[Block]:
    """Text blocks in page order: runs of text between block-level tags. Scripts, styles, the title and hidden parts give none.

    Takes a time in proportion to the page's length, however deep it is nested or badly closed.
    """
    out: list[Block] = []
    tree = Open()
    stack = tree.stack
    serial, parts, linked, total = 0, [], 0, 0
    endless: set[str] = set()

    def flush() -> None:
        nonlocal parts, linked, total
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip() if parts else ""
        if text:
            tag, region, number = tree.boxes[-1]
            out.append(Block(text, linked / max(1, total), tag, number, tree.boxes[-2][2] if len(tree.boxes) > 1 else -1, region))
        parts, linked, total = [], 0, 0

    def add(text: str) -> None:
        nonlocal linked, total
        if text and not stack[-1][2]:
            parts.append(text)
            n = len(text) - text.count(" ")
            total += n
            linked += n if stack[-1][3] else 0

    def close(upto: int) -> None:
        if tree.holds_container(upto):
            flush()
        tree.cut(upto)

    def end_of(kind: str, start: int) -> re.Match | None:
        """The end after start; where there is none, there is none after any later start either."""
        found = None if kind in endless else _ENDS[kind].search(page, start)
        if found is None:
            endless.add(kind)
        return found

    at = 0
    while m := _MARKUP.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        name = m.group(4)
        if name is None:
            if m.group(2):
                if end := end_of("cdata", at):
                    add(html.escape(page[at:end.start()]))
                    at = end.end()
                else:
                    at = (page.find(">", at) + 1) or len(page)
            elif m.group(1):
                flush()
            continue
        name = name.lower()
        if m.group(3):
            if name == "p" and not tree.within(("p",), SCOPES):
                flush()
            if i := tree.last(name):
                close(i)
            continue
        if name == "title" and (end := end_of("title", at)):
            at = end.end()
            continue
        if name in ("html", "head", "body"):
            flush()
            continue
        if name in VOID:
            if name not in ("wbr", "img"):
                add(" ") if name == "br" else flush()
            continue
        if name in CLOSES_P and (i := tree.within(("p",), SCOPES)):
            close(i)
        if name in SAME and (i := tree.within(SAME[name], SCOPES - {name})):
            close(i)
        if name not in INLINE:
            flush()
        serial += 1
        attributes = m.group(5) if m.group(5) is not None else m.group(6)
        region = stack[-1][1]
        if name in BOILER_TAGS or name == "header" and not any(map(tree.last, CONTENT_TAGS)):
            region = -REGION
        elif name in CONTENT_TAGS and region >= 0:
            region = REGION
        pairs = [(n.lower(), a or b or c) for n, a, b, c in _ATTRIBUTE.findall(attributes)] if attributes else []
        words = " ".join(value for n, value in pairs if n in _HINTS)
        if words:
            region = hint(name, words, region)
        hidden = stack[-1][2] or is_hidden(pairs)
        if not attributes.endswith("/") or name in INLINE - MATH or name in CLOSES_P:
            tree.push(name, region, serial, hidden, stack[-1][3] + (name == "a"))
    add(page[at:])
    flush()
    return out


def log_odds(b: Block) -> float:
    """Classifier: log odds that the block is content."""
    words = b.text.count(" ") + 1
    x = BIAS + PER_WORD * min(words, MOST_WORDS) + PER_LINK * b.link + b.region
    x += PER_SENTENCE if _SENTENCE.search(b.text) else 0.0
    x += HEADING if b.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else 0.0
    return x + (ITEM if b.tag in ("li", "td", "th", "button", "label") else 0.0)


def edges(row: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block with the next one, and with the next one under the same parent.

    A neighbour counts less unless both are in one container, or the containers are in one or one in the other.
    """
    out, last = [], {}
    for i, b in enumerate(row):
        if i:
            a = row[i - 1]
            near = a.parent == b.parent or a.outer in (b.parent, b.outer) or b.outer == a.parent
            out.append((i - 1, i, ADJACENT if a.region == b.region and near else DISTANT))
        if b.parent in last and last[b.parent] != i - 1:
            out.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return out


def min_cut(costs: list[tuple[float, float]], ties: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut.

    ``costs`` holds (capacity from the source, capacity to the sink): what it
    costs to leave a node on the sink side, or on the source side. Ties cost
    when their ends are apart. Augmenting along shortest paths (Dinic 1970);
    what a node can send straight through is sent first.
    """
    n = len(costs)
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def connect(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, (up, down) in enumerate(costs):
        through = min(up, down)
        if up - through > 0:
            connect(s, i, up - through, 0.0)
        if down - through > 0:
            connect(i, t, down - through, 0.0)
    for a, b, c in ties:
        connect(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-12)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[a] < len(head[a]):
                e = head[a][following[a]]
                if room[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(head[a]):
                path.append(head[a][following[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                following[a] += 1
            else:
                break


def labelled(page: str | None) -> list[tuple[str, bool]]:
    """(block text, is content) in page order; a null page has no blocks."""
    row = blocks(page or "")
    odds = [log_odds(b) for b in row]
    chosen = min_cut([(max(x, 0.0), max(-x, 0.0)) for x in odds], edges(row))
    return [(b.text, c) for b, c in zip(row, chosen)]


def main_text(page: str | None) -> str:
    return " ".join(text for text, content in labelled(page) if content)


def with_main_text(pages: DataFrame, name: str = "text") -> DataFrame:
    """pages with the main text of html; empty where there is none, also for null. Rows and other columns stay.

    A column called ``name``, letter case aside, is replaced.
    """
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    return pages.withColumn(name, extract(F.col("html")))


def op3_html_text(spark, folder: str) -> DataFrame:
    x = with_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return x.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
