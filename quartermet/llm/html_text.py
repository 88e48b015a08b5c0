"""Main text of web pages by a minimum cut.

A page is cut into blocks at block-level tags.  A linear classifier gives each
block the log odds of being content, from its words, links and punctuation and
from the elements around it; positive ones become capacities from the source,
negative ones to the sink.  Blocks that follow each other, and more so those of
one parent or of near ancestors, are joined by smoothness capacities.  What the
source still reaches after the maximum flow is content.

Names of classes and ids are evidence of a part, not of a state ("has-sidebar",
"related-on", "alert-free" name none).  Where they, or a form, would take away the
only ``<article>`` or ``<main>`` of a page and most of its words, they say nothing:
some sites wrap the whole page in a form or an element of such a name.

The text is what HTML shows: character references decoded, white space (line
breaks too) within a block one space, blocks joined by line ends.  Scripts, styles,
comments and the head are no text.  NULL and empty pages, and pages without
content, have an empty text.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, small

MADE = T.StructType().add("main_text", "string").add("n_blocks", "integer").add("n_kept", "integer")

# Element names of HTML, and words that sites name their parts by.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
HIDDEN = "script style noscript template textarea title svg math iframe object select option datalist button canvas"
CLOSES = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
}
AWAY_TAGS = set("nav footer aside form dialog menu fieldset".split())
MAIN_TAGS = set("article main".split())
AWAY_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"overlay|sidebar|side|nav|navbar|navigation|menu|breadcrumbs?|footer|masthead|comments?|commentlist|respond|reply|"
    r"replies|disqus|discussion|share|sharing|social|related|recommend\w*|newsletter|subscribe|subscription|signup|"
    r"login|widgets?|toolbar|pagination|pager|copyright|legal|disclaimer)(?![a-z])"
)
HEAD_WORDS = re.compile(r"(?:^|[^a-z])(?:header|topbar|site-title|branding)(?![a-z])")
MAIN_WORDS = re.compile(r"(?:^|[^a-z])(?:article|content|main|post|entry|story|articlebody|body-text)(?![a-z])")
AWAY_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu form".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|"
    rf"<({HIDDEN.replace(' ', '|')}|head)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?:.*?)(?:</\1\s*>|(?=<body[\s>])|\Z)|"
    r"<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
# Words that make a name one of a state, and parts that hold readers' words.
STATE_WORDS = set("has have with without no not on free enabled disabled".split())
READER_WORDS = re.compile(r"(?:^|[^a-z])(?:comments?|commentlist|respond|reply|replies|disqus|discussion)(?![a-z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass(frozen=True)
class Costs:
    """Log odds by feature, and capacities between blocks."""

    base: float = -0.8
    words: float = 0.9  # for each natural logarithm of 1 + words
    links: float = -5.0  # times the share of characters in links
    sentence: float = 0.8  # ends like a sentence
    paragraph: float = 1.0
    heading: float = 0.8
    item: float = -0.6
    main: float = 4.0
    away: float = -14.0
    neighbour: float = 0.7
    sibling: float = 1.2
    cousin: float = 0.5


@dataclass
class Block:
    text: str
    tag: str
    parent: int  # number of the element around it
    grand: int
    linked: float
    main: bool
    away: bool
    soft: tuple[int, ...] = ()  # numbers of the elements around it that only a name or a form speaks against


@dataclass
class Page:
    """Blocks of a page, and the elements with ``<article>`` or ``<main>`` in them that only a name or a form speaks against."""

    blocks: list[Block]
    around: set[int]  # such elements; forms also with an element that is named as main text
    forms: set[int]
    open_main: bool  # an element named as main text stands outside all of them


def _says(value: str, main: bool) -> tuple[bool, bool, bool]:
    """Whether a class or id names a part with main text, one with none, and one of readers."""
    names = [n for n in value.split() if not STATE_WORDS.intersection(re.split(r"[^a-z]+", n))]
    value = " ".join(names)
    away = bool(AWAY_WORDS.search(value) or (HEAD_WORDS.search(value) and not main))
    return not away and bool(MAIN_WORDS.search(value)), away, bool(READER_WORDS.search(value))


def _judged(tag: str, attributes: str, main: bool) -> tuple[bool, bool, bool]:
    """Whether an element says that it holds the main text, or none of it, or only its name says the latter."""
    found, soft = tag in MAIN_TAGS, tag == "form"
    away = tag in AWAY_TAGS and not soft
    if tag == "header" and not main:
        away = True
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            good, bad, readers = _says(value, main)
            away = away or readers and tag not in ("body", "html")
            soft = soft or bad and tag not in ("body", "html")
            found = found or good
        elif name == "role":
            away = away or value in AWAY_ROLES
            found = found or value in ("main", "article")
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            away = True
        elif name == "style" and UNSEEN.search(value):
            away = True
    return found and not away and (not soft or tag in MAIN_TAGS), away, soft and not away


def _unseen(attributes: str) -> bool:
    """Whether an element within a line is not shown."""
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or (name == "style" and UNSEEN.search(value.lower())):
            return True
    return False


def blocks(page: str) -> Page:
    """The blocks of a page that hold text."""
    out: list[Block] = []
    made = Page(out, set(), set(), False)
    # Open elements: tag, number, holds main text, holds none, those around it of which a name or a form says so.
    stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = [("", 0, False, False, ())]
    unseen: list[str] = []  # open elements within a line that are not shown, and those in them
    count = link = 0
    pieces: list[str] = []
    in_links = total = 0

    def flush() -> None:
        nonlocal in_links, total
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                tag, number, main, away, soft = stack[-1]
                grand = stack[-2][1] if len(stack) > 1 else 0
                out.append(Block(text, tag, number, grand, in_links / max(total, 1), main, away, soft))
            pieces.clear()
        in_links = total = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not unseen:
            piece = page[at : m.start()]
            pieces.append(piece)
            size = len(piece.strip())
            total += size
            if link:
                in_links += size
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                link = 0 if m[2] else 1
            if m[2]:
                if tag in unseen:
                    while unseen.pop() != tag:
                        pass
            elif unseen or (m[4] and _unseen(m[4])):
                unseen.append(tag)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        flush()
        unseen.clear()
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in VOID:
            continue
        closes = CLOSES.get(tag, {"p"})
        while len(stack) > 1 and stack[-1][0] in closes:
            stack.pop()
        count += 1
        _, _, main, away, soft = stack[-1]
        found, off, named = _judged(tag, m[4], main)
        if not away and not off:
            if named:
                soft = (*soft, count)
                if tag == "form":
                    made.forms.add(count)
            if found and not soft:
                made.open_main = True
            elif found:
                made.around.update(e for e in soft if tag in MAIN_TAGS or e in made.forms)
        if not m[4].endswith("/"):
            stack.append((tag, count, main or found, away or off, soft))
    if at < len(page) and not unseen:
        rest = page[at:]
        pieces.append(rest)
        total += len(rest.strip())
        in_links += len(rest.strip()) if link else 0
    flush()
    return made


def settled(page: Page) -> list[Block]:
    """The blocks, each told whether something around it speaks against it.

    An element that only its name speaks against is taken back if it holds more
    than half of the words outside links and the only ``<article>`` or ``<main>``
    (a form: or the only element named as main text).
    """
    words: dict[int, float] = {}
    total = 0.0
    for b in page.blocks:
        if not b.away:
            n = (b.text.count(" ") + 1) * (1 - b.linked)
            total += n
            for e in b.soft:
                words[e] = words.get(e, 0.0) + n
    back = set() if page.open_main else {e for e, n in words.items() if e in page.around and 2 * n > total}
    return [replace(b, away=True) if set(b.soft) - back else b for b in page.blocks]


def log_odds(block: Block, costs: Costs) -> float:
    z = costs.base + costs.words * math.log1p(block.text.count(" ") + 1) + costs.links * block.linked
    if block.text[-1] in ".!?…:\"”»":
        z += costs.sentence
    if block.tag == "p":
        z += costs.paragraph
    elif block.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        z += costs.heading
    elif block.tag in ("li", "td", "th", "dt", "dd"):
        z += costs.item
    return z + costs.main * block.main + costs.away * block.away


def minimum_cut(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut (Dinic's algorithm); capacities are whole numbers.

    Positive odds are capacities from the source, negative ones to the sink.
    """
    n = len(odds)
    source, sink = n, n + 1
    near: list[list[int]] = [[] for _ in range(n + 2)]  # numbers of arcs; arc ^ 1 runs back
    head: list[int] = []
    room: list[int] = []

    def arc(a: int, b: int, forth: int, back: int) -> None:
        near[a].append(len(head))
        near[b].append(len(head) + 1)
        head.extend((b, a))
        room.extend((forth, back))

    for i, z in enumerate(odds):
        if z > 0:
            arc(source, i, z, 0)
        elif z < 0:
            arc(i, sink, -z, 0)
    for a, b, capacity in edges:
        arc(a, b, capacity, capacity)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                if room[e] and level[head[e]] < 0:
                    level[head[e]] = level[a] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if not room[e])
                a = head[path[full] ^ 1]
                del path[full:]
                continue
            while tried[a] < len(near[a]):
                e = near[a][tried[a]]
                if room[e] and level[head[e]] == level[a] + 1:
                    break
                tried[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = head[e ^ 1]
                tried[a] += 1
                continue
            path.append(e)
            a = head[e]


def main_blocks(page: str, costs: Costs = Costs()) -> tuple[list[str], int]:
    """Texts of the content blocks, and how many blocks there are."""
    found = settled(blocks(page))
    odds = [round(100 * log_odds(b, costs)) for b in found]
    if all(z >= 0 for z in odds):
        return [b.text for b in found], len(found)
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            before = found[i - 1]
            weight = costs.neighbour
            if before.parent == b.parent:
                weight += costs.sibling
            elif before.grand == b.grand or before.parent == b.grand or before.grand == b.parent:
                weight += costs.cousin
            edges.append((i - 1, i, round(100 * weight)))
        # The last block below the same ancestor, if others stand between.
        if b.grand in last and last[b.grand] < i - 1:
            edges.append((last[b.grand], i, round(100 * costs.cousin)))
        last[b.grand] = i
    return [b.text for b, keep in zip(found, minimum_cut(odds, edges), strict=True) if keep], len(found)


def extract(pages: DataFrame, column: str = "html", costs: Costs = Costs()) -> DataFrame:
    """Rows of ``pages`` as ``row`` (without the html) with main_text, n_blocks and n_kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            made = [main_blocks(x.decode(), costs) for x in batch.column("text").to_pylist()]
            columns = [["\n".join(t) for t, _ in made], [n for _, n in made], [len(t) for t, _ in made]]
            kinds = [pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["row", *MADE.names],
            )

    return map_rows(pages, work, MADE, column, keep=False)


def main_text(pages: DataFrame) -> DataFrame:
    """Columns page_id, url, text, n_chars."""
    return extract(pages).select(
        F.col("row.page_id").alias("page_id"), F.col("row.url").alias("url"), F.col("main_text").alias("text"),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )
