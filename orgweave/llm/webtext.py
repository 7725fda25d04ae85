"""Main text of web pages by minimum-cut labelling of text blocks.

A page is read into blocks: runs of text between block-level tags, each with its open elements. A linear
classifier gives each block log-odds of being content, from the whole block; over 0 they are its capacity to the
terminal of content, under 0 to that of boilerplate. Neighbours in page order, and blocks that follow one another
inside one element, are joined by smoothness edges whose capacity falls with their distance in the element tree, and
falls more where one of them lies in an element that is marked as boilerplate and the other doesn't.
The minimum cut, found by maximum flow, is the labelling of least total cost. No mark decides alone: all weights are of the
size of the evidence that text gives.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, ready

# Element names by how they are read.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("datalist head option script select style template textarea title".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol menu dl table select body html".split())
OUTSIDE = frozenset("nav footer aside form menu dialog button noscript".split())
INSIDE = frozenset("article main".split())
# Words in class, id and role values.
BAD_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner captcha comment comments commentlist consent cookie cookies discussion disqus donate gdpr login modal newsletter notice notices notification paywall popup promo promotion promoted recommended related replies reply respond share sharing signup sponsor sponsored subscribe subscription trending alert".split())
LAYOUT_WORDS = frozenset("breadcrumb breadcrumbs complementary contentinfo copyright disclaimer footer form header legal masthead menu nav navbar navigation pager pagination privacy search sidebar skip social tagcloud toolbar widget".split())
GOOD_WORDS = frozenset("article articlebody body content entry main page post story text".split())
#: Parts of a name that say what shape its element has, not what it holds.
SHAPES = frozenset("area bar block body bottom box button col column container content group holder inner item items label left line link links list main module outer panel right row section slot text top unit widget wrap wrapper zone".split())
#: First parts of a name that tells a state of the page.
STATES = frozenset("has hide is js no non not show with without".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_STOPS = re.compile(r"[.!?,;:。，](?:\s|$)")

#: Weights of the classifier, in log-odds of content. ``length`` and ``stops`` are reached by long texts with many stops.
WEIGHTS = {"base": -1.4, "paragraph": 1.0, "heading": 1.2, "item": -0.3, "length": 3.0, "stops": 2.0, "links": -4.0, "inside": 3.0, "good": 1.5, "outside": -9.0, "bad": -9.0, "layout": -8.0, "header": -8.0}
#: Words and stops at which half of their weight is reached.
HALF_WORDS, HALF_STOPS = 12, 3
#: Capacity of an edge between blocks of one parent, its factor for each step further apart, and where only one is marked.
SMOOTH, DECAY, BORDER = 1.5, 0.6, 0.2
_SCALE = 1000


def attributes(source: str) -> dict[str, str]:
    """An element's attributes by lower-case name; of a name that is given twice the first counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), entities.unescape(a or b or c))
    return out


def meanings(name: str) -> set[str]:
    """What a class, id or role says its element is: the last part of each of its names that is no mere shape.

    ``ad-slot`` and ``sidebarAd`` are an ad, ``ad-free`` and ``alert-story`` are not, ``no-comments`` is nothing, ``main`` is main.
    """
    out = set()
    for one in name.split():
        parts = [x.lower() for x in _PARTS.findall(one)]
        if not parts or len(parts) > 1 and parts[0] in STATES:
            continue
        out.add(next((x for x in reversed(parts) if x not in SHAPES), parts[-1]))
    return out


class Block(NamedTuple):
    text: str
    path: tuple[int, ...]
    tag: str
    words: int
    stops: int
    linked: float
    outside: bool
    bad: bool
    layout: bool
    inside: bool
    good: bool
    header: bool


class Element:
    __slots__ = ("number", "tag", "hidden", "link", "outside", "bad", "layout", "inside", "good", "header")

    def __init__(self, number: int, tag: str, attrs: str, parent: Element | None):
        self.number, self.tag = number, tag
        words, hidden = set(), tag in HIDDEN
        if attrs and not attrs.isspace():
            found = attributes(attrs)
            for x in ("class", "id", "role", "itemprop"):
                words |= meanings(found.get(x, ""))
            hidden |= "hidden" in found or "display:none" in "".join(found.get("style", "").lower().split())
        self.link = tag == "a" or bool(parent and parent.link)
        structural = tag not in ("html", "body")
        self.hidden = hidden or bool(parent and parent.hidden)
        self.outside = tag in OUTSIDE or bool(parent and parent.outside)
        self.bad = bool(structural and words & BAD_WORDS) or bool(parent and parent.bad)
        # an article inside a wrapper named for the page's layout is an article; a header inside it is its own
        inherited = bool(parent and parent.layout) and tag not in INSIDE
        own = words & (LAYOUT_WORDS - {"header"} if parent and parent.inside else LAYOUT_WORDS)
        self.layout = inherited or bool(structural and own and tag not in INSIDE)
        self.inside = tag in INSIDE or bool(parent and parent.inside)
        self.good = bool(structural and words & GOOD_WORDS) or bool(parent and parent.good)
        self.header = tag == "header" and not self.inside or bool(parent and parent.header and tag not in INSIDE)


def blocks(page: str | None) -> list[Block]:
    """The blocks of visible text in page order."""
    page = page or ""
    out: list[Block] = []
    stack = [Element(0, "html", "", None)]
    buffer: list[str] = []
    linked = number = at = 0
    end = len(page)

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                e = next((x for x in reversed(stack) if x.tag in BLOCK), stack[0])
                out.append(Block(text, tuple(x.number for x in stack if x.tag in BLOCK), e.tag, len(text.split()), len(_STOPS.findall(text)), min(1.0, linked / len(text)), e.outside or stack[-1].outside, stack[-1].bad, stack[-1].layout, e.inside, e.good, e.header))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].hidden:
            buffer.append(text)
            if stack[-1].link:
                linked += len(text)

    def pop_to(k: int) -> None:
        if any(x.tag in BLOCK for x in stack[k:]):
            flush()
        del stack[max(k, 1) :]

    while at < end:
        m = _TOKEN.search(page, at)
        add(page[at : m.start() if m else end])
        if not m:
            break
        at = m.end()
        if m["cdata"]:
            add(entities.escape(m["cdata"]))
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "br":
                add(" ")
            elif tag == "p" and not any(x.tag == "p" for x in stack):
                flush()
            else:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if k:
                    pop_to(k)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                add(" ")
            continue
        if tag in BLOCK:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in SIBLINGS.get(tag, ()) or stack[k].tag == "p" and tag in CLOSES_P:
                    pop_to(k)
                    break
                if stack[k].tag in SCOPES or stack[k].tag in ("div", "section", "article") and tag not in CLOSES_P:
                    break
            flush()
        if m["attrs"].endswith("/") and tag not in BLOCK:
            continue
        number += 1
        stack.append(Element(number, tag, m["attrs"], stack[-1]))
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            stack.pop()
    flush()
    return out


def log_odds(b: Block) -> float:
    """The classifier: positive for content."""
    w = WEIGHTS
    x = w["base"] + w["length"] * b.words / (b.words + HALF_WORDS) + w["stops"] * b.stops / (b.stops + HALF_STOPS) + w["links"] * b.linked
    x += w["heading"] if b.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else w["item"] if b.tag in ("li", "td", "th", "option", "dt", "dd") else w["paragraph"] if b.tag in ("p", "blockquote", "pre") else 0.0
    x += w["inside"] * b.inside + w["good"] * (b.good and not b.inside) + w["outside"] * b.outside + w["bad"] * b.bad + w["layout"] * b.layout + w["header"] * b.header
    return x


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges ``(i, j, capacity)`` of page order and of blocks that follow one another in one element."""

    def capacity(i: int, j: int) -> int:
        a, b = found[i].path, found[j].path
        k = 0
        while k < len(a) and k < len(b) and a[k] == b[k]:
            k += 1
        border = BORDER if marked[i] != marked[j] else 1.0
        return int(_SCALE * SMOOTH * border * DECAY ** max(0, len(a) + len(b) - 2 * k - 2))

    marked = [b.outside or b.bad or b.layout or b.header for b in found]
    out, last = [], {}
    for j, b in enumerate(found):
        near = {j - 1} if j else set()
        for depth in (-1, -2):
            parent = b.path[:depth] if len(b.path) > -depth else ()
            if parent:
                if (i := last.get(parent)) is not None:
                    near.add(i)
                last[parent] = j
        out += [(i, j, c) for i in near if (c := capacity(i, j))]
    return out


def minimum_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source. ``gain`` over 0 is a capacity from the source, under 0 one to the sink.

    Dinic's algorithm: levels by breadth, then augmenting walks along them.
    """
    n = len(gain)
    left = list(gain)
    to: list[list[int]] = [[] for _ in range(n)]
    ends: list[int] = []
    room: list[int] = []
    for i, j, c in edges:
        to[i].append(len(ends))
        to[j].append(len(ends) + 1)
        ends += [j, i]
        room += [c, c]
    while True:
        level = [0 if g > 0 else -1 for g in left]
        todo = deque(i for i in range(n) if left[i] > 0)
        reach = False
        while todo:
            i = todo.popleft()
            reach |= left[i] < 0
            for e in to[i]:
                j = ends[e]
                if room[e] and level[j] < 0:
                    level[j] = level[i] + 1
                    todo.append(j)
        if not reach:
            return [x >= 0 for x in level]
        turn = [0] * n
        for s in range(n):
            while left[s] > 0 and level[s] == 0:
                path: list[int] = []
                i = s
                while True:
                    if left[i] < 0 and path:
                        push = min(left[s], -left[i], min(room[e] for e in path))
                        left[s] -= push
                        left[i] += push
                        for e in path:
                            room[e] -= push
                            room[e ^ 1] += push
                        break
                    while turn[i] < len(to[i]):
                        e = to[i][turn[i]]
                        if room[e] and level[ends[e]] == level[i] + 1:
                            break
                        turn[i] += 1
                    else:
                        if not path:
                            i = -1
                            break
                        i = ends[path.pop() ^ 1]
                        turn[i] += 1
                        continue
                    path.append(e)
                    i = ends[e]
                if i < 0:
                    break


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by blank lines."""
    found = blocks(page)
    gain = [round(_SCALE * log_odds(b)) or -1 for b in found]
    if any(g > 0 for g in gain):
        keep = minimum_cut(gain, smoothness(found)) if any(g < 0 for g in gain) else [True] * len(found)
        return "\n\n".join(b.text for b, k in zip(found, keep, strict=True) if k)
    return ""


def _extract(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*columns, "text", "n_chars"])

    return run


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text, n_chars`` for every row of ``pages``.

    Character references are decoded, white space inside a block is one space, blocks are joined by two line
    feeds in page order. A null or empty page, and one without content, gives an empty text; repeated rows give equal
    rows, an empty table none. A block whose log-odds are 0 is boilerplate by itself, and of several minimum cuts the one
    with the most content stands. What a page hides by ``hidden`` or ``display:none`` isn't text. Other columns are not read.
    """
    ready(pages.sparkSession)
    types = dict(pages.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "text string, n_chars long"])
    return pages.select(*keep, F.col(html_col).alias(fresh(pages, "html"))).mapInArrow(_extract(list(keep)), schema)
