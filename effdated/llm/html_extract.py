"""HTML extraction (operator 3): minimum-cut labelling of text blocks.

A page is cut into blocks (runs of text between block-level tags). Blocks and the containers around
them are the nodes of a graph:

* a linear classifier over a block's text (length, link density, tag, sentence end) and one over a
  container's tag, role and names give costs, the capacities to the content or the boilerplate terminal;
* smoothness edges join neighbouring blocks (the stronger, the closer they are in the DOM), a block
  and its container, and a container and the one around it.

The minimum cut, by max-flow, separates content from boilerplate on every page. A sentence in an
advert box is no content although it reads like it, and a bare word in the article is, since their
containers weigh more; a container without a hint goes with what it holds. Names count by
their place: ``ad`` in ``ad-top`` says more than in ``text-ad-free``.

Scripts, styles, head, forms' controls and the like never become blocks. Character
references are decoded, white space inside a block becomes one space, blocks are joined in
page order by two line feeds. Null or empty HTML gives an empty text; broken markup is
parsed as far as it goes. Very long or deep pages are parsed whole, linear in their length (DOM
proximity looks at the ``NEAR`` nearest containers). Where both cuts of a block cost the same it is
boilerplate. Repeated rows, null ids and clashing extra columns change nothing.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
#: Never part of any block.
DROPPED = frozenset("script style noscript template head title iframe object svg canvas math audio video select option textarea button datalist map noembed noframes".split())
#: A start tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("ul ol dl table article section main body div td th".split())

#: Hints by tag and role: 1 content, -1 boilerplate unless an article stands inside, -2 boilerplate.
TAG_HINT = {"article": 1, "main": 1, "nav": -2, "footer": -2, "aside": -2, "menu": -2, "dialog": -2, "form": -1, "header": -1, "search": -2}
ROLE_HINT = {"main": 1, "article": 1, "navigation": -2, "banner": -1, "contentinfo": -2, "complementary": -2, "search": -2, "form": -1, "alert": -2, "dialog": -2, "menu": -2, "menubar": -2}
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner billboard breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "copyright disclaimer disqus footer footnav gdpr login masthead menu menus modal nav navbar navigation newsletter notice notices notification "
    "outbrain pager pagination paywall popup promo promotion recommended related reply replies respond share sharing sidebar sidebars signup skip "
    "social sponsor sponsored subscribe subscription taboola toolbar topbar trending widget widgets".split())
GOOD_WORDS = frozenset("article articlebody body content entry hentry main maincontent post posttext story text".split())
#: Before a bad word, these say that it is about the page's layout.
LAYOUT_WORDS = frozenset("has with no without hide show is".split())
#: After a bad word, these say that there is none of it.
NEGATIONS = frozenset("free less off none".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: The block classifier, in log odds for content (fixed weights).
W_BIAS, W_PER_CHAR, W_LENGTH_MOST, W_LINKS, W_SENTENCE, W_COPYRIGHT = 0.1, 0.01, 2.0, -3.0, 0.5, -3.0
W_TAG = {"p": 1.0, "blockquote": 1.0, "pre": 1.0, "h1": 0.6, "h2": 0.5, "h3": 0.5, "h4": 0.3, "li": -0.5, "td": -0.2, "th": -0.2}
#: The container classifier: by hint, once and for every block that the container holds itself.
W_HINT, W_HINT_PER_BLOCK = {1: 4.0, 0: 0.0, -1: -5.0, -2: -8.0}, {1: 4.0, 0: 0.0, -1: -4.0, -2: -6.0}
#: Smoothness: neighbours at DOM distance d, block to a container with and without a hint, container to container.
S_NEIGHBOUR, S_HINTED, S_CONTAINER, S_NESTED = 0.8, 6.5, 0.3, 0.2
_UNIT = 1000
#: Containers above a block that its DOM distance to others looks at.
NEAR = 16


def _attribute_hint(tag: str, attrs: dict[str, str]) -> int:
    if tag in ("html", "body"):
        return 0
    hint = ROLE_HINT.get(attrs.get("role", "").strip().lower(), 0)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return -2
    if hint or tag in ("article", "main"):
        words = _WORDS.findall(attrs.get("class", "") + " " + attrs.get("id", ""))
        return -2 if {"comment", "comments", "reply"} & {w.lower() for w in words} else hint
    good = False
    for value in (attrs.get("class", ""), attrs.get("id", "")):
        for name in value.split():
            words = [w.lower() for w in _WORDS.findall(name)]
            for i, w in enumerate(words):
                off = (i and words[i - 1] in LAYOUT_WORDS) or (i + 1 < len(words) and words[i + 1] in NEGATIONS)
                if w in BAD_WORDS and not off:
                    return -2
                if w == "header" and not (i and words[i - 1] in GOOD_WORDS):
                    return -1
                good |= w in GOOD_WORDS
    return int(good)


class Page(HTMLParser):
    """Blocks of a page: ``(text, characters in links, tag, numbers of the nearest containers, outermost first)``,
    and the hints of containers by number."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []  # tag, hint
        self.around: list[tuple[str, int]] = []  # open block-level elements: tag, node number
        self.open: dict[str, int] = {}  # open elements by tag
        self.hints: dict[int, int] = {}
        self.blocks: list[tuple[str, int, str, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.linked = self.dropped = self.nodes = 0

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tag = self.around[-1][0] if self.around else "body"
                near = tuple(n for t, n in self.around[-NEAR - 3:] if t not in ("html", "body"))
                if tag in W_TAG:  # the block's own tag is no container
                    near = near[:-1]
                self.blocks.append((text, self.linked, tag, near[-NEAR:]))
            self.parts = []
        self.linked = 0

    def _pop(self, at: int) -> None:
        for tag, _ in self.stack[at:]:
            self.dropped -= tag in DROPPED
            self.open[tag] -= 1
            if tag in BLOCK:
                self.around.pop()
        del self.stack[at:]

    def _close(self, names: set[str], scope: frozenset[str]) -> None:
        """Close the open elements of these names that stand inside the nearest of ``scope``."""
        if any(self.open.get(n) for n in names):
            for i in range(len(self.stack) - 1, -1, -1):
                name = self.stack[i][0]
                if name in names:
                    self._pop(i)
                    if not any(self.open.get(n) for n in names):
                        break
                elif name in scope:
                    break

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK or tag in DROPPED:
            self._flush()
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in BLOCK:  # end tags that HTML leaves out
            self._close({"p", *CLOSES.get(tag, ())}, _SCOPE)
            if tag == "body" and self.open.get("head"):
                self._pop(next(i for i, (name, _) in enumerate(self.stack) if name == "head"))
        if tag == "a" and self.open.get("a"):
            self._pop(next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == "a"))
        hint = self.stack[-1][1] if self.stack else 0
        own = _attribute_hint(tag, {k: v or "" for k, v in attrs}) if attrs else 0
        own = own if own else TAG_HINT.get(tag, 0) if not (tag == "header" and hint == 1) else 0
        if tag in ("article", "main") and own == 0:
            own = 1
        if hint > -2 and own:
            hint = own if own != -1 or hint != 1 or tag == "form" else hint
        self.nodes += 1
        self.stack.append((tag, hint))
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag in BLOCK:
            self.around.append((tag, self.nodes))
        if hint:
            self.hints[self.nodes] = hint
        self.dropped += tag in DROPPED

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK or tag in DROPPED:
            self._flush()
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                self._pop(i)
                return
            if name in ("article", "main", "body", "table") and tag not in BLOCK:
                return  # a stray inline end tag closes no container

    def handle_data(self, data):
        if self.dropped:
            return
        self.parts.append(data)
        if self.open.get("a"):
            self.linked += len("".join(data.split()))

    def close(self):
        super().close()
        self._flush()


def block_cost(text: str, linked: int, tag: str) -> float:
    """Log odds that a block is content, by its own text and tag."""
    cost = W_BIAS + W_TAG.get(tag, 0.0) + min(W_LENGTH_MOST, W_PER_CHAR * len(text))
    cost += W_LINKS * min(1.0, linked / max(1, len(text.replace(" ", ""))))
    if text[-1] in ".!?…\"”»":
        cost += W_SENTENCE
    if len(text) < 200 and ("©" in text or "copyright" in text.lower() or "all rights reserved" in text.lower()):
        cost += W_COPYRIGHT
    return cost


def min_cut(terminal: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Source side of a minimum cut. ``terminal[i]``: capacity from the source if positive,
    to the sink if negative; ``edges``: ``(i, j, capacity)`` in both directions. Dinic."""
    n = len(terminal)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b), room.append(there)
        out[b].append(len(to))
        to.append(a), room.append(back)

    for i, c in enumerate(terminal):
        if c > 0:
            add(source, i, c, 0)
        elif c < 0:
            add(i, sink, -c, 0)
    for i, j, c in edges:
        add(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:  # dead end
                level[a] = -1
                a = to[path.pop() ^ 1]


def _distance(x: tuple[int, ...], y: tuple[int, ...]) -> int:
    """Steps between two places in the DOM over their nearest common container, as far as known."""
    known = {n: i for i, n in enumerate(reversed(y))}
    return next((i + known[n] for i, n in enumerate(reversed(x)) if n in known), len(x) + len(y))


def label(blocks: list[tuple[str, int, str, tuple[int, ...]]], hints: dict[int, int] | None = None) -> list[bool]:
    """True for content: the content side of the minimum cut. Nodes are the blocks and their containers."""
    hints = hints or {}
    terminal = [block_cost(*b[:3]) for b in blocks]
    edges: dict[tuple[int, int], float] = {}
    container: dict[int, int] = {}

    def node(number: int) -> int:
        if number not in container:
            container[number] = len(terminal)
            terminal.append(W_HINT[hints.get(number, 0)])
        return container[number]

    for i, (_, _, _, near) in enumerate(blocks):
        if i:
            edges[i - 1, i] = S_NEIGHBOUR / (1 + _distance(near, blocks[i - 1][3]))
        if near:
            own, hint = node(near[-1]), hints.get(near[-1], 0)
            terminal[own] += W_HINT_PER_BLOCK[hint]
            edges[i, own] = S_HINTED if hint else S_CONTAINER
            for x, y in zip(near, near[1:]):
                edges[node(x), node(y)] = S_NESTED
    return min_cut([round(_UNIT * t) for t in terminal], [(i, j, round(_UNIT * w)) for (i, j), w in edges.items()])[: len(blocks)]


def extract(html: str | None) -> str:
    """Main text of a page."""
    if not html:
        return ""
    page = Page()
    page.feed(html)
    page.close()
    return "\n\n".join(b[0] for b, keep in zip(page.blocks, label(page.blocks, page.hints)) if keep)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` per row of ``pages``."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url"), F.col(f"`{html_col}`").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["_id", "_url", "text", "n_chars"])

    return rows.mapInArrow(run, "_id long, _url string, text string, n_chars long").withColumnsRenamed({"_id": id_col, "_url": url_col})
