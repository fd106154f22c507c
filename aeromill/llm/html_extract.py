"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks (runs of text between block-level tags). A logistic classifier over each
block's text (length, link density, sentence end, heading) says how likely it is to be content; that
is all it sees, so a long advert looks like content and a one-word paragraph like boilerplate. The
graph has a node for each block and one for each element that says something about what is in it
(the container: article, nav, a class such as ``advert``). The classifier's odds and the containers'
are the capacities of the edges to the two terminals. Smoothness edges join

* neighbouring blocks, and blocks that follow each other in one DOM parent, with a capacity that
  falls with their distance in the tree;
* each block with its nearest container, and that with the one around it. These are directed: what
  lies in furniture is hardly ever content, while an article may well hold furniture.

The maximum flow (blocking flows over shortest paths) gives the cut that labels all blocks at once:
a few doubtful words follow the article or the paragraphs around them, a form's label the form.
Containers of soft kinds (forms, headers) turn content themselves where the text in them outweighs
them.

The classifier's weights are set by hand, as no labelled pages exist. Parsing is linear in the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_rows

#: Elements whose content is never text of the page (fixed values).
RAW = frozenset("script style noscript template textarea title iframe svg object math canvas audio video select datalist".split())
#: Elements that begin and end blocks (fixed values).
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre search section summary table caption tbody td tfoot th thead tr ul button".split()
)
#: Elements that have no content (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a following one of the same kind, or the end of the parent, closes.
IMPLIED = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
#: Elements at which an implied end stops.
SCOPE = frozenset("ul ol menu dl table body html article section div aside nav main form fieldset".split())

#: Odds against furniture that is so for sure and as a rule, and for an article by element and by class.
HARD, SOFT, ARTICLE, BODY_ODDS = 1e7, 6.0, 1e6, 3.0
#: Kinds of elements: furniture for sure, furniture as a rule, content (fixed values).
HARD_ELEMENTS = frozenset("nav footer aside menu button dialog search option".split())
SOFT_ELEMENTS = frozenset("form header fieldset legend".split())
BODY_ELEMENTS = {"article": 4.5, "main": 3.0}
BODY_CLASS = 2.0
#: Weights of words in class, id, role and aria-label.
FURNITURE = re.compile(
    r"^(?:ads?|advert\w*|adsense|adslot|adbox|adunit|adsbygoogle|sponsor\w*|promo\w*|banners?|notifications?|announcements?|toast|nav\w*|menus?|breadcrumbs?|foot(?:er)?|masthead|side(?:bar|nav)?|aside|complementary"
    r"|contentinfo|navigation|cookies?|consent|gdpr|notices?|alerts?|disclaimer|popup|modal|overlay|comments?|commentlist|replies|reply|disqus|respond"
    r"|related|recommend\w*|share|sharing|social|newsletter|subscribe|signup|login|search|toolbar|widgets?|pagination|pager|tags?|toc|skip|hidden|copyright)$"
)
#: Words that say nothing in a compound such as site-footer; any other word makes it something else.
NEUTRAL = re.compile(r"^(?:site|page|main|top|bottom|left|right|global|primary|secondary|mobile|desktop|box|block|bar|wrap|wrapper|container|area|section|inner|outer|list|items?|links?|unit|slot|group|row|col|column|header|by|the|us|post|form|js|[0-9]+)?$")
BODY = re.compile(r"^(?:article|story|post|entry|content|main|maincontent|body|text|articlebody)$")
HEADER = re.compile(r"^(?:header|head|top|topbar)$")

BIAS = -1.0
LENGTH_WEIGHT, LINK_WEIGHT, SENTENCE_WEIGHT, COPYRIGHT_WEIGHT, HEADING_WEIGHT = 0.6, -4.0, 0.8, -3.0, 1.0
#: Capacity of the edge between neighbours at no distance in the tree.
SMOOTHNESS = 1.0

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|(?=<)|\Z)|<[!?][^<>]*+(?:>|(?=<)|\Z)", re.S
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none")
_LONG_NUMBER = re.compile(r"&#(?:[0-9]{10,}|[xX][0-9a-fA-F]{10,});?")
#: Elements that hold a whole page or text.
WHOLE = frozenset("html body main article".split())
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Node:
    name: str
    parent: Node | None
    depth: int
    in_article: bool
    odds: float = 0.0  # of this element as a container; 0 says nothing
    pull: float = 0.0  # on what is in it, if it is content
    inline: bool = False
    chars: int = 0
    shaded: bool = False  # it or an element around it is furniture


@dataclass
class Block:
    node: Node
    text: str
    chars: int
    link_chars: int
    heading: bool


def _means(words: list[str], kind: re.Pattern) -> bool:
    """Whether a whole class token is of a kind: has a word of it, and else only neutral ones."""
    return any(kind.match(w) for w in words) and all(kind.match(w) or NEUTRAL.match(w) for w in words)


def _signs(attrs: str, in_article: bool) -> float:
    """What an element's attributes say: -HARD, -SOFT, 0 or BODY_CLASS."""
    odds = 0.0
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            for token in value.split():
                words = _SPLIT.split(token)
                if _means(words, FURNITURE):
                    odds = -HARD
                elif not in_article and _means(words, HEADER):
                    odds = min(odds, -SOFT)
                elif any(BODY.match(w) for w in words) and odds >= 0:
                    odds = BODY_CLASS
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return -HARD
    return odds


def unescaped(raw: str) -> str:
    """Character references decoded; numbers too long to be one are U+FFFD."""
    if "&" not in raw:
        return raw
    return html.unescape(_LONG_NUMBER.sub("\ufffd", raw) if "&#" in raw else raw)


@dataclass
class _Builder:
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    links: int = 0
    node: Node = field(default_factory=lambda: Node("#root", None, 0, False))
    nodes: list[Node] = field(default_factory=list)
    open: Counter = field(default_factory=Counter)
    open_inline: Counter = field(default_factory=Counter)

    def text(self, raw: str, literal: bool = False) -> None:
        if raw:
            shown = raw if literal else unescaped(raw)
            self.parts.append(shown)
            if self.links:
                self.link_chars += len(shown)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.node, text, len(text), self.link_chars, self.node.name in ("h1", "h2", "h3", "h4", "h5", "h6")))
            self.node.chars += len(text)
        self.parts, self.link_chars = [], 0

    def close(self, names: set[str] | frozenset[str], stop: frozenset[str] = frozenset()) -> None:
        if not any(self.open[n] for n in names):
            return
        at: Node | None = self.node
        while at is not None and at.name not in names:
            if at.name in stop:
                return
            at = at.parent
        if at is not None and at.parent is not None:
            while self.node is not at.parent:
                self.open[self.node.name] -= 1
                self.open_inline[self.node.name] -= self.node.inline
                self.node = self.node.parent
            self.links = 0

    def start(self, name: str, attrs: str) -> None:
        self.flush()
        if name in IMPLIED:
            self.close(set(IMPLIED[name].split()), SCOPE)
        elif name in BLOCK:
            self.close({"p"}, SCOPE)
        inside = self.node.in_article or name in BODY_ELEMENTS
        pull = BODY_ELEMENTS.get(name, 0.0)
        odds = ARTICLE if pull else -HARD if name in HARD_ELEMENTS else -SOFT if name in SOFT_ELEMENTS else 0.0
        if name == "header" and self.node.in_article:
            odds = 0.0
        if attrs.strip(" /"):
            signs = _signs(attrs, inside)
            # Classes of a whole page or article tell of its layout or topic.
            if signs < 0 and (name not in WHOLE or _HIDDEN.search(attrs)):
                odds, pull = min(odds, signs), 0.0
            elif signs > 0 and odds >= 0:
                odds, pull = max(odds, BODY_ODDS), max(pull, signs)
        inside = inside or (pull > 0 and name not in WHOLE)
        node = Node(name, self.node, self.node.depth + 1, inside, odds, pull, inline=name not in BLOCK)
        self.node = node
        self.nodes.append(node)
        self.open[name] += 1
        self.open_inline[name] += node.inline

    def within(self, name: str) -> bool:
        """Whether an inline element of that name is open that is judged by itself."""
        if not self.open_inline[name]:
            return False
        at: Node | None = self.node
        while at is not None and at.inline:
            if at.name == name:
                return True
            at = at.parent
        return False

    def settle(self) -> None:
        """A form around most of the page's text is no sign of furniture."""
        most = sum(b.chars for b in self.blocks) / 2
        for n in reversed(self.nodes):
            if n.name == "form" and n.odds == -SOFT and n.chars > most:
                n.odds = 0.0
            n.parent.chars += n.chars
        for n in self.nodes:
            n.shaded = n.odds < 0 or n.parent.shaded


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, each with its place in the tree."""
    build, at, size = _Builder(), 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            build.text(page[at:])
            break
        build.text(page[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            build.text(m["cdata"], literal=True)
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name in RAW and not m["end"]:
            if not m["attrs"].endswith("/") or name in ("script", "style", "textarea", "title"):
                stop = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
                close = page.find(">", stop.end()) if stop else -1
                at = close + 1 if close >= 0 else size
            build.parts.append(" ")
        elif name in VOID:
            if name in BLOCK:
                build.flush()
            else:
                build.parts.append(" " if name == "br" else "")
        elif name in BLOCK:
            if m["end"]:
                build.flush()
                build.close({name})
            else:
                build.start(name, m["attrs"])
        elif name == "a":
            build.links = 0 if m["end"] else 1
        elif m["end"]:
            if build.within(name):
                build.flush()
                build.close({name})
        elif build.within(name) or (m["attrs"].strip(" /") and _signs(m["attrs"], True) <= -HARD):
            build.start(name, m["attrs"])
    build.flush()
    build.settle()
    return build.blocks


def classify(block: Block) -> float:
    """Log odds that the block is content, from its text alone."""
    odds = BIAS + LENGTH_WEIGHT * math.log1p(block.chars / 20)
    odds += LINK_WEIGHT * min(1.0, block.link_chars / max(block.chars, 1))
    if block.text[-1] in ".!?…\"”»":
        odds += SENTENCE_WEIGHT
    if block.heading:
        odds += HEADING_WEIGHT
    if not block.node.in_article and (block.text[0] == "©" or "all rights reserved" in block.text[:200].lower()):
        odds += COPYRIGHT_WEIGHT
    return odds


def tree_distance(a: Node, b: Node) -> int:
    """Edges between two elements in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def graph(found: list[Block]) -> tuple[list[float], list[tuple[int, int, float, float]]]:
    """(odds of the blocks and then of the containers, edges).

    An edge (i, j, c, d) costs c where only i is content and d where only j is.
    """
    odds, out, last = [classify(b) for b in found], [], {}
    number: dict[int, int] = {}
    around: dict[int, Node | None] = {}  # nearest container of an element, itself included

    def container(node: Node | None) -> Node | None:
        passed = []
        while node is not None and node.odds == 0 and id(node) not in around:
            passed.append(node)
            node = node.parent
        answer = around[id(node)] if node is not None and node.odds == 0 else node
        for n in passed:
            around[id(n)] = answer
        return answer

    def join(i: int, node: Node | None) -> None:
        c = container(node)
        while c is not None:
            new = id(c) not in number
            if new:
                number[id(c)] = len(odds)
                odds.append(c.odds)
            furniture = i >= len(found) and odds[i] < 0  # no article pulls at that
            out.append((i, number[id(c)], HARD if c.shaded else 0.0, 0.0 if furniture else c.pull))
            if not new:
                return
            i, c = number[id(c)], container(c.parent)

    for i, b in enumerate(found):
        if i:
            near = SMOOTHNESS / (1 + tree_distance(found[i - 1].node, b.node) / 2)
            out.append((i - 1, i, near, near))
        parent = id(b.node.parent)
        if parent in last and last[parent] != i - 1:
            out.append((last[parent], i, SMOOTHNESS / 2, SMOOTHNESS / 2))
        last[parent] = i
    for i, b in enumerate(found):
        join(i, b.node)
    return odds, out


def min_cut(gains: list[float], joined: list[tuple[int, int, float, float]]) -> list[bool]:
    """Whether each node is on the source side of the minimum cut.

    ``gains`` is the capacity from the source less that to the sink (the common part of both is cut
    either way). Edges (i, j, c, d): capacity c from i to j, d back. Each round sends a blocking flow
    along the shortest paths, so the rounds are as many as there are lengths of such paths.
    """
    left, n, tiny = list(gains), len(gains), 1e-6
    to: list[int] = []
    room: list[float] = []
    around: list[list[int]] = [[] for _ in gains]
    for i, j, c, d in joined:
        for a, b, r in ((i, j, c), (j, i, d)):
            around[a].append(len(to))
            to.append(b)
            room.append(r)
    while True:
        level = [-1] * n
        queue = [i for i in range(n) if left[i] > tiny]
        for i in queue:
            level[i] = 0
        ends = n + 1  # level of the nearest sinks
        for i in queue:  # grows while it is read
            if level[i] >= ends:
                break
            for e in around[i]:
                j = to[e]
                if level[j] < 0 and room[e] > tiny:
                    level[j] = level[i] + 1
                    queue.append(j)
                    if left[j] < -tiny:
                        ends = level[j]
        if ends > n:
            return [x >= 0 for x in level]
        at = [0] * n
        for source in range(n):
            if level[source] != 0:
                continue
            path: list[int] = []  # edges from the source on
            i = source
            while left[source] > tiny:
                if left[i] < -tiny and i != source:
                    flow = min(left[source], -left[i], min(room[e] for e in path))
                    left[source] -= flow
                    left[i] += flow
                    back = len(path)
                    for k, e in enumerate(path):
                        room[e] -= flow
                        room[e ^ 1] += flow
                        if room[e] <= tiny and k < back:
                            back = k
                    if left[i] < -tiny or back < len(path):
                        i = to[path[back] ^ 1] if back < len(path) else i
                        del path[back:]
                    continue
                while at[i] < len(around[i]):
                    e = around[i][at[i]]
                    j = to[e]
                    if room[e] > tiny and level[j] == level[i] + 1:
                        break
                    at[i] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    i = to[e ^ 1]
                    at[i] += 1
                    continue
                path.append(e)
                i = j


def main_text(page: str | None) -> str:
    """The blocks that the cut leaves with the content, joined by line feeds; "" if none."""
    found = blocks(page or "")
    if not found:
        return ""
    kept = min_cut(*graph(found))
    return "\n".join(b.text for b, k in zip(found, kept, strict=False) if k)


SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every whole page: one row per row of ``pages`` (page_id, url, html).

    A null or empty page, or one without content, has the text "". Repeated rows give repeated
    results; no rows give none; other columns are ignored. No shuffle.
    """

    def make():
        def one(page_id, url, page):
            text = main_text(page)
            return [(page_id, url, text, len(text))]

        return one

    return map_rows(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")), make, SCHEMA)
