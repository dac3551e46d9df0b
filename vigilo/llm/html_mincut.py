"""Main text of HTML pages by minimum-cut labelling of text blocks.

A page's text blocks are the nodes of a graph. A linear classifier turns each
block's features (landmark elements, class and id words, link density, length,
punctuation) into a terminal capacity: to the source for content, to the sink
for boilerplate. Blocks that follow each other and blocks of one parent element
are tied by smoothness edges, heavier the closer they stand in the DOM and light where a boilerplate container
begins or ends. The minimum cut separates content from boilerplate: a short
line between paragraphs stays with them, a line of prose between link lists
goes with those. Pages are independent rows; Spark spreads them, and a task
holds one small batch at a time.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.llm.common import table

# HTML element names by role, and words of class, id and role attributes.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p
pre section select summary table tbody td tfoot th thead tr ul""".split())
RAW_TAGS = frozenset("script style template textarea title noscript svg math iframe object canvas".split())
#: Of these, the ones whose content is plain text up to their own end tag; the others hold markup.
PLAIN_TAGS = frozenset("script style textarea title noscript iframe".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_TAGS = frozenset("nav header footer aside form button select menu dialog fieldset label".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset("""ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent
contentinfo cookie cookies dialog disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice
pagination pager popup promo promoted promotion recommended related replies reply respond search share sharing sidebar sidebars signup
social sponsor sponsored subscribe subscription tags toolbar topbar widget""".split())
CONTENT_WORDS = frozenset("article content entry main post story text body articlebody".split())
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
LAYOUT_WORDS = frozenset("has no with without".split())  # "has-sidebar" names a neighbour, not the element itself
CLOSES = {  # an opening element ends an open one of these, up to the nearest container
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: What is left of an edge's weight where it crosses the border of a boilerplate container.
BORDER = 0.25
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"""
                  r"""|<[!?/][^>]*(?:>|\Z)""", re.S)
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in PLAIN_TAGS}
_SCRIPT = re.compile(r"<!--|-->|<(/?)script(?=[\s/>])", re.I)
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Element:
    __slots__ = ("tag", "parent", "depth", "boiler", "content", "hidden", "last")

    def __init__(self, tag, attrs, parent):
        self.tag, self.parent, self.last = tag, parent, -1
        self.depth = parent.depth + 1 if parent else 0
        self.boiler = parent.boiler if parent else 0
        self.content = parent.content if parent else 0
        self.hidden = bool(parent and parent.hidden)
        words = set()
        for name, value in _ATTR.findall(attrs) if attrs else ():
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (
                    name == "style" and "display:none" in value.replace(" ", "").lower()):
                self.hidden = True
            elif name in ("class", "id", "role"):
                words.update(w.lower() for w in _WORD.findall(value))
        if tag in ("html", "body"):
            return
        named = set() if words & LAYOUT_WORDS else words & BOILER_WORDS
        if words & {"article", "entry", "post", "story"} or self.content:
            named -= {"header"}  # a text's own head
        if tag in CONTENT_TAGS:  # only a reader's comment is marked up as an article and is none
            named &= COMMENT_WORDS if tag == "article" else set()
        if named or tag in BOILER_TAGS and not (tag == "header" and self.content):
            self.boiler += 1
        elif words & CONTENT_WORDS or tag in CONTENT_TAGS:
            self.content += 1


def _plain_end(html: str, name: str, at: int) -> int:
    """Where the end tag of a plain text element starts whose content starts at ``at`` (-1: none)."""
    if name != "script":
        m = _END[name].search(html, at)
        return m.start() if m else -1
    comment = inner = False  # a script element inside a comment of the script has an end tag of its own
    while m := _SCRIPT.search(html, at):
        at = m.end()
        if m[0] == "<!--":
            if not comment:
                comment, at = True, at - 2  # its dashes may be those of the end
        elif m[0] == "-->":
            comment = inner = False
        elif not m[1]:
            inner = comment
        elif inner:
            inner = False
        else:
            return m.start()
    return -1


def blocks(html: str) -> list[tuple[str, _Element, int]]:
    """Text blocks in page order: (text, innermost block element, characters inside links)."""
    out, buffer = [], []
    node = _Element("html", "", None)
    opened: dict[str, list[_Element]] = {}  # open elements by name, so that no tag walks over its ancestors
    links = link_depth = at = 0
    skip = None

    def leave(to):
        nonlocal node
        while node is not to:
            opened[node.tag].pop()
            node = node.parent

    def innermost(names):
        return max((opened[n][-1] for n in names if opened.get(n)), key=lambda e: e.depth, default=None)

    def flush():
        nonlocal links
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            out.append((text, node, links))
        links = 0

    def add(raw):
        nonlocal links
        if raw:
            text = unescape(raw) if "&" in raw else raw
            buffer.append(text)
            if link_depth:
                links += len(text.strip())

    while m := _TAG.search(html, at):
        if skip is None:
            add(html[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        if skip is not None:
            if closing and name == skip:
                skip = None
            elif not closing and name in PLAIN_TAGS and skip not in ("svg", "math") and not (m[3] or m[6] or "").rstrip().endswith("/"):
                end = _plain_end(html, name, at)
                at = end if end >= 0 else at
            continue
        if not closing and name in RAW_TAGS:
            if name in BLOCK_TAGS:
                flush()
            attrs = (m[3] or m[6] or "").rstrip()
            skip = None if attrs.endswith("/") else name
            if skip in PLAIN_TAGS:
                at = _plain_end(html, name, at)
                if at < 0:
                    break
            continue
        if name == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
        elif name in VOID_TAGS:
            if name == "hr":
                flush()
            else:
                buffer.append(" ")
        elif name in BLOCK_TAGS or name == "head":
            flush()
            link_depth = 0
            if closing:
                if top := innermost((name,)):
                    leave(top.parent)
            elif name not in ("html", "body"):
                if node.tag == "head" and name != "head" or node.tag == "p":
                    leave(node.parent)
                ends, stop = CLOSES.get(name, ((), ()))
                top, wall = innermost(ends), innermost(stop)
                if top and (wall is None or top.depth > wall.depth):
                    leave(top.parent)
                node = _Element(name, m[3] or m[6], node)
                opened.setdefault(name, []).append(node)
            elif node.tag == "head":
                leave(node.parent)
    if skip is None:
        add(html[at:])
    flush()
    return out


def score(text: str, node: _Element, links: int) -> float:
    """The classifier: above 0 for content, below for boilerplate."""
    n = text.count(" ") + 1
    s = -1.0
    if node.hidden or node.tag == "head":
        return -12.0
    s += -8.0 if node.boiler else 4.0 if node.content else 0.0
    s += 3.5 if n >= 40 else 2.5 if n >= 20 else 1.0 if n >= 8 else 0.0
    ended, heading = text[-1] in ".!?…\"”»。", node.tag in ("h1", "h2", "h3", "blockquote", "pre")
    s += 1.0 * ended + 0.5 * heading
    s -= 1.5 if n < 4 and not (ended or heading or node.content) else 0.0
    s += 1.0 if node.tag == "p" else 0.0
    density = links / len(text)
    return s - (3.5 * density if density > 0.3 else 0.0)


def smoothness(nodes: list[_Element]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order and between blocks of one parent element."""
    edges = []

    def tie(i, j, weight):
        apart = (nodes[i].boiler > 0) != (nodes[j].boiler > 0)
        edges.append((i, j, weight * (BORDER if apart else 1.0)))

    for i, b in enumerate(nodes):
        home = b.parent or b
        if i:
            a = nodes[i - 1]
            tie(i - 1, i, 1.8 if a is b or (a.parent or a) is home else 0.6 if (a.parent and a.parent.parent is home.parent) else 0.2)
        if 0 <= home.last < i - 1:
            tie(home.last, i, 0.6)
        home.last = i
    return edges


def min_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True = source side) of the minimum cut; ties go to the sink side.

    A node whose terminal outweighs all its edges keeps its terminal's label in
    every minimum cut; it is settled first and its edges become terminal
    capacity of its neighbours. Augmenting paths settle what remains.
    """
    n = len(unary)
    cap, near = list(unary), [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    tie = [sum(w for _, w in x) for x in near]
    label: list[bool | None] = [None] * n
    ready = deque(range(n))
    while ready:
        i = ready.popleft()
        if label[i] is not None or abs(cap[i]) <= tie[i] and not (tie[i] == 0):
            continue
        label[i] = cap[i] > 0
        for j, w in near[i]:
            if label[j] is None:
                cap[j] += w if label[i] else -w
                tie[j] -= w
                if tie[j] < 1e-9:
                    tie[j] = 0
                ready.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return [bool(x) for x in label]
    flow: dict[int, dict[int, float]] = {i: {} for i in rest}
    for a, b, w in edges:
        if label[a] is None and label[b] is None:
            flow[a][b] = flow[a].get(b, 0.0) + w
            flow[b][a] = flow[b].get(a, 0.0) + w
    source = {i: cap[i] for i in rest if cap[i] > 0}
    sink = {i: -cap[i] for i in rest if cap[i] < 0}
    spent: set[int] = set()  # reach no sink any more: the source side of the cut
    for start in source:
        while source[start] > 1e-12 and start not in spent:
            before, queue, goal = {start: -1}, deque([start]), None
            while queue:
                i = queue.popleft()
                if sink.get(i, 0.0) > 1e-12:
                    goal = i
                    break
                for j, c in flow[i].items():
                    if c > 1e-12 and j not in before and j not in spent:
                        before[j] = i
                        queue.append(j)
            if goal is None:
                spent.update(before)
                break
            path, i = [goal], goal
            while before[i] >= 0:
                i = before[i]
                path.append(i)
            push = min(source[start], sink[goal], *(flow[b][a] for a, b in zip(path, path[1:])))
            source[start] -= push
            sink[goal] -= push
            for a, b in zip(path, path[1:]):
                flow[b][a] -= push
                flow[a][b] += push
    for i in rest:
        label[i] = i in spent
    return [bool(x) for x in label]


def labelled(html: str | None) -> list[tuple[str, float, bool]]:
    """Blocks in page order: (text, classifier score, label of the cut)."""
    found = blocks(html or "")
    costs = [score(*b) for b in found]
    return [(b[0], c, x) for b, c, x in zip(found, costs, min_cut(costs, smoothness([b[1] for b in found])))]


def main_text(html: str | None) -> str:
    return "\n".join(text for text, _, keep in labelled(html) if keep)


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        text = [main_text(h) for h in df["html"]]
        yield pd.DataFrame({"page_id": df["page_id"], "url": df["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html, ...)`` -> page_id, url, text, n_chars, one row per input row.

    Null or empty html and pages without content give an empty text. Broken or
    cut markup is read as far as it goes (an unfinished tag at the end is no
    text). Repeated rows get equal answers, null ids and urls stay null, other
    columns are ignored, no rows give no rows.
    """
    rows = pages.select(F.col("page_id").cast("string"), F.col("url").cast("string"), F.col("html").cast("string"))
    return (rows.mapInPandas(_extracted, "page_id string, url string, text string, n_chars long")
            .withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType)))


def op9_minimum_cut_extraction(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))
