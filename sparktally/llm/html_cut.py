"""Main text of web pages: a minimum cut between content and boilerplate."""

from __future__ import annotations

import heapq
import html
import re
from collections import Counter, deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names of the HTML standard by their role.
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup
option p pre search section select summary table tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("""script style noscript template textarea title iframe noembed noframes xmp svg annotation
annotation-xml""".split())
_ENDS_P = _BLOCK - {"body", "html"}
_SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
_FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "option": {"select"}}

# Costs of the classifier in units of log odds: by element, and by words in class, id, role.
_BAD_TAGS = frozenset("nav footer aside form button select menu dialog fieldset".split())
_GOOD_TAGS = frozenset("article main".split())
_BAD_WORDS = frozenset("""ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs comment
comments commentlist disqus consent cookie cookies copyright disclaimer footer form hidden login masthead menu menubar
modal nav navbar navigation newsletter notice notification outbrain pager pagination popup privacy promo promotion
feedback recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe
subscription taboola tags toolbar tooltip widget widgets complementary contentinfo dialog alert announcement gdpr legal
overlay paywall policy sitemap thread threads toc warning""".split())
_GOOD_WORDS = frozenset("article articlebody content entry main post story".split())
# What follows these in a class name says that the page has it elsewhere, or not at all.
_ABOUT_OTHERS = ("has-", "with-", "without-", "no-", "not-")
# What follows these is the topic of a text, unless it ends in a part of a page.
_TOPICS = ("category-", "tag-")
_PARTS = ("list", "menu", "nav", "navigation", "navbar", "sidebar", "toolbar", "widget", "widgets")
# Beside the class "layout" these say where the other columns stand.
_COLUMNS = frozenset("left-sidebar right-sidebar sidebar-left sidebar-right sidebars".split())
# Class words that text alone does not outweigh.
_SURE_WORDS = frozenset("""comment comments commentlist consent cookie cookies copyright disqus footer gdpr reply replies
respond thread threads""".split())
_CERTAIN, _LIKELY, _OUTSIDE = 12.0, 5.0, 6.0
_ADJACENT, _SIBLING = 1.0, 1.0
# A list or a table is one thing: its blocks hold together, and it belongs to what stands beside it.
_WHOLES = frozenset("ul ol dl table".split())
_WITHIN, _BESIDE = 2.0, 2.0
# What speaks for the longest text of a page.
_LONGEST = 3.5
# From so many characters on a block is running text; so much of it makes a page, and so many times the rest outweighs it.
_RUNNING, _PAGE, _TIMES = 60, 400, 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
                        re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class _Region:
    """What the names of an element say; elements that say nothing share their parent's."""

    parent: "_Region | None"
    own: float  # log odds for boilerplate that the element gives all its blocks
    claim: bool = False  # class words speak for boilerplate; whether they count, `_open_claims` says
    good: bool = False  # the element speaks for content
    head: bool = False  # in an article or main element that no class word speaks against
    sure: bool = False  # the claim has words that text alone does not outweigh
    named: bool = False  # this element or one around it speaks for content
    article: bool = False  # in an article element
    cost: float = 0.0
    inside_good: bool = False


@dataclass
class _Element:
    tag: str
    parent: "_Element | None"
    region: _Region
    whole: "_Element | None" = None  # the outermost list or table that it is, or is in


@dataclass
class Block:
    """A run of text between two block borders."""

    parent: _Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links
    text: str = ""


def _region(tag: str, attributes: str, around: _Region) -> _Region:
    """What an element says, beside what is said around it; `around` itself if that is nothing."""
    region = _said(tag, attributes, around)
    if region is not around:
        region.article = around.article or tag == "article"
    return region


def _said(tag: str, attributes: str, around: _Region) -> _Region:
    own, certain, good = 0.0, False, tag in _GOOD_TAGS
    names: list[str] = []
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or (
                    name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                own += _CERTAIN
            elif name == "role":
                certain = certain or not _BAD_WORDS.isdisjoint(_WORDS.findall(value))
                names.append(value)
            elif name != "style":
                names += value.split()
    words: set[str] = set()
    named = tag == "main"
    for token in names:
        if token.startswith(_ABOUT_OTHERS) or token in _COLUMNS and "layout" in names:
            continue
        if token.startswith(_TOPICS) and not token.endswith(_PARTS):
            continue
        found = _WORDS.findall(token)
        words.update(found)
        named = named or not _GOOD_WORDS.isdisjoint(found) and _BAD_WORDS.isdisjoint(found) and "header" not in found
    bad = words & _BAD_WORDS
    if tag in _BAD_TAGS or certain or tag == "header" and not around.named:
        return _Region(around, own + _CERTAIN, named=around.named)
    if tag == "article" and around.article:
        # An article in an article is most often a comment on it; whether that counts, its text says.
        return _Region(around, own, True, False, False, bool(bad & _SURE_WORDS), around.named)
    if bad or "header" in words and not around.named:
        # The classes of an article tell its topics too.
        if not (named and tag in _GOOD_TAGS):
            return _Region(around, own, True, good or named, False, bool(bad & _SURE_WORDS),
                           around.named or good or named)
    elif words & _GOOD_WORDS:
        good = True
    if not own and (not good or around.named and tag not in _GOOD_TAGS):
        return around
    return _Region(around, own, False, good, around.head or tag in _GOOD_TAGS and not bad, False, around.named or good)


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page in order; markup, comments, scripts and styles are left out.

    Unclosed and stray tags are taken as browsers do: a paragraph ends where a block
    starts, an end tag closes what is open inside its element, an unknown one nothing.
    """
    root = _Element("html", None, _Region(None, 0.0))
    regions = [root.region]
    stack = [root]
    opened: Counter[str] = Counter()  # open elements by tag, so that stray end tags cost no search
    inside = [0]  # places of the open block elements; the outermost stands for the page
    links = 0
    blocks: list[Block] = []
    current: Block | None = None
    at, end = 0, len(page)

    def add(text: str) -> None:
        nonlocal current
        if current is None:
            if text.isspace():
                return
            holder = stack[inside[-1]]
            current = Block(holder)
            # Inline elements with a cost of their own, such as a marked span, count too.
            if stack[-1].region is not holder.region:
                current.parent = stack[-1]
            blocks.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def close(upto: int) -> None:
        nonlocal links
        while len(stack) > upto:
            tag = stack.pop().tag
            opened[tag] -= 1
            if inside[-1] == len(stack):
                inside.pop()
            links -= tag == "a"

    while at < end:
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at:token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            where = None
            if opened[tag]:
                where = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
            if tag in _BLOCK and (where is not None or tag == "p"):
                current = None
            if where is not None:
                costly = stack[-1].region is not stack[where - 1].region
                close(where)
                if costly:
                    current = None
            continue
        if tag in _RAW:
            # Their content is no text of the page; it ends at their own end tag only.
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            if not token[3].rstrip().endswith("/") or tag not in ("svg", "annotation", "annotation-xml"):
                at = stop.end() if stop else end
            continue
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if tag in _BLOCK:
            current = None
            if tag in _ENDS_P:
                if stack[inside[-1]].tag == "p":
                    close(inside[-1])
            if tag in _SAME_ENDS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in _FENCE[tag]:
                        break
                    if stack[i].tag in _SAME_ENDS[tag]:
                        close(i)
                        break
        if tag in _VOID:
            continue
        if tag in ("html", "body"):
            continue
        element = _Element(tag, stack[-1], _region(tag, token[3], stack[-1].region), stack[-1].whole)
        if element.whole is None and tag in _WHOLES:
            element.whole = element
        if element.region is not stack[-1].region:
            regions.append(element.region)
            current = None
        if tag in _BLOCK:
            inside.append(len(stack))
        stack.append(element)
        opened[tag] += 1
        links += tag == "a"
    kept = []
    for block in blocks:
        text = "".join(block.parts)
        block.text = " ".join((html.unescape(text) if "&" in text else text).split())
        if block.text:
            kept.append(block)
    _open_claims(regions, kept)
    for region in regions[1:]:
        around = region.parent
        region.cost = around.cost + region.own + _CERTAIN * region.claim
        region.inside_good = around.inside_good
        # Inside boilerplate such a name says what the boilerplate holds, not where the article is.
        if region.good and region.cost <= 0:
            region.cost -= _LIKELY * (not around.inside_good)
            region.inside_good = True
    return kept


def _open_claims(regions: list[_Region], blocks: list[Block]) -> None:
    """Class words do not count on an element that holds the page's text.

    The claimed elements are taken from the one with most text on, each at most once, and an inner
    one after those around it.  What no claim covers is the rest.  An element that speaks for content too
    is opened if it holds more than the rest; one with a heading or an article, if it holds more running
    text than the rest, and several times as much if the rest has a heading or an article too; any
    other one if the rest is next to nothing.
    """
    if not any(r.claim for r in regions):
        return
    place = {id(r): i for i, r in enumerate(regions)}
    n = len(regions)
    up = [place[id(r.parent)] if r.parent else -1 for r in regions]
    shut, cover = [False] * n, [-1] * n  # inside certain boilerplate; the innermost claim
    for i, r in enumerate(regions):
        if r.parent:
            shut[i] = r.own > 0 or shut[up[i]]
            cover[i] = i if r.claim else cover[up[i]]
    # Of all inside each region; and of what lies directly under each claim, last of the rest.
    text, running, head = [0] * n, [0] * n, [False] * n
    direct, content, lead = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
    for block in blocks:
        i = place[id(block.parent.region)]
        if shut[i]:
            continue
        plain = max(0, len(block.text) - block.linked)
        long = plain if plain >= _RUNNING and 2 * plain > len(block.text) else 0
        first = block.parent.tag == "h1" or regions[i].head
        text[i] += plain
        running[i] += long
        head[i] = head[i] or first
        direct[cover[i]] += long
        content[cover[i]] += plain * regions[i].named
        lead[cover[i]] = lead[cover[i]] or first
    for i in range(n - 1, 0, -1):
        text[up[i]] += text[i]
        running[up[i]] += running[i]
        head[up[i]] = head[up[i]] or head[i]
    inner: list[list[int]] = [[] for _ in range(n + 1)]
    for i, r in enumerate(regions):
        if r.claim and not shut[i]:
            inner[cover[up[i]]].append(i)
    waiting = [(-text[i], i) for i in inner[-1]]
    heapq.heapify(waiting)
    while waiting:
        _, i = heapq.heappop(waiting)
        rest = max(direct[-1], content[-1])
        known = lead[-1] and rest > 0
        if regions[i].good:
            opened = text[i] > rest
        elif head[i]:
            opened = running[i] > rest * (_TIMES if known else 1)
        else:
            opened = (not regions[i].sure and not known and not content[-1]
                      and running[i] >= _PAGE and running[i] > _TIMES * rest)
        if opened:
            regions[i].claim = False
            direct[-1] += direct[i]
            content[-1] += content[i]
            lead[-1] = lead[-1] or lead[i]
            for j in inner[i]:
                heapq.heappush(waiting, (-text[j], j))


def _length_cost(length: int) -> float:
    return 1.0 if length < 60 else -1.5 if length > 200 else -0.5


def costs_of(blocks: list[Block]) -> list[float]:
    """Log odds of each block that it is boilerplate: what its elements say, then what its text says.

    Outside of elements that speak for content, text speaks by its length, its end, its element and
    the share of it that is linked.  A list or table is judged as a whole, and each of its blocks takes its
    share of that; a few links speak little against it.  Where no element speaks for content, the
    longest text is likely what the page is for; where one does, what lies outside is likely not.
    """
    elsewhere = any(b.parent.region.inside_good and b.parent.region.cost < 0 for b in blocks)
    of_whole: dict[int, list[int]] = {}
    longest = 0
    for block in blocks:
        if block.parent.whole is not None:
            found = of_whole.setdefault(id(block.parent.whole), [0, 0, 0])
            found[0] += len(block.text)
            found[1] += 1
            found[2] += min(block.linked, len(block.text))
        if block.parent.region.cost <= 0 and 2 * block.linked < len(block.text):
            longest = max(longest, len(block.text))
    costs = []
    for block in blocks:
        region, length = block.parent.region, len(block.text)
        cost = region.cost
        if region.inside_good or block.parent.whole is None:
            cost += 3.0 * min(1.0, block.linked / length)
        if not region.inside_good:
            if block.parent.whole is not None:
                total, n, linked = of_whole[id(block.parent.whole)]
                cost += _length_cost(total) / n + 3.0 * (linked / total) ** 2
            else:
                cost += _length_cost(length)
                cost -= 0.5 * (block.text[-1] in ".!?…\"”»")
                cost -= 1.0 * (block.parent.tag in ("p", "h1", "blockquote", "pre"))
            if elsewhere:
                cost += _OUTSIDE
            elif region.cost <= 0 and 2 * block.linked < length and length == longest:
                cost -= _LONGEST
        costs.append(cost)
    return costs


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks that likely belong together.

    Neighbours on the page; neighbours under one parent or grandparent; neighbours within one list or
    table; and a list or table with the block before and after it, if they stand side by side in the tree.
    """
    edges = []
    for i in range(len(blocks) - 1):
        a, b = blocks[i].parent, blocks[i + 1].parent
        weight = _ADJACENT
        if a.whole is not None and a.whole is b.whole:
            weight += _WITHIN
        elif a.whole is not None or b.whole is not None:
            a, b = a.whole or a, b.whole or b
            if a.parent is b.parent or a is b.parent or a.parent is b:
                weight += _BESIDE
        edges.append((i, i + 1, weight))
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        near = block.parent.parent or block.parent
        if (before := last.get(id(near))) is not None:
            edges.append((before, i, _SIBLING))
        last[id(near)] = i
    return edges


def minimum_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are boilerplate in a labelling of least total cost.

    A node labelled content pays its cost if positive, one labelled
    boilerplate its negated cost if negative, and an edge whose ends differ
    pays its weight.  Nodes whose cost outweighs their edges are settled
    first, which no least labelling contradicts; the others are separated by a
    maximum flow from source (boilerplate) to sink (content).
    """
    n = len(costs)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    cost = list(costs)
    open_weight = [sum(w for _, w in x) for x in near]
    label: list[bool | None] = [None] * n
    queue = deque(i for i in range(n) if abs(cost[i]) > open_weight[i])
    while queue:
        i = queue.popleft()
        if label[i] is not None:
            continue
        label[i] = cost[i] > 0
        for j, w in near[i]:
            if label[j] is None:
                cost[j] += w if label[i] else -w
                open_weight[j] -= w
                if abs(cost[j]) > open_weight[j]:
                    queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {node: k for k, node in enumerate(rest)}
        flow = _Flow(len(rest) + 2)
        source, sink = len(rest), len(rest) + 1
        for node, k in place.items():
            if cost[node] > 0:
                flow.edge(source, k, cost[node], 0.0)
            elif cost[node] < 0:
                flow.edge(k, sink, -cost[node], 0.0)
        for a, b, w in edges:
            if a in place and b in place:
                flow.edge(place[a], place[b], w, w)
        side = flow.source_side(source, sink)
        for node, k in place.items():
            label[node] = side[k]
    return [bool(x) for x in label]


class _Flow:
    """Maximum flow by blocking flows on levels."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float) -> None:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Which nodes the source still reaches once no more can flow."""
        while (level := self._levels(source))[sink] >= 0:
            tried = [0] * len(self.out)
            path: list[int] = []
            at = source
            while True:
                if at == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    first = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    at = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                while tried[at] < len(self.out[at]):
                    e = self.out[at][tried[at]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[at] + 1:
                        path.append(e)
                        at = self.to[e]
                        break
                    tried[at] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    at = self.to[e ^ 1]
                    tried[at] += 1
        return [x >= 0 for x in level]


def main_text(page: str) -> str:
    """The article of a page: its content blocks, joined by line feeds."""
    blocks = blocks_of(page)
    away = minimum_cut(costs_of(blocks), smoothness(blocks))
    return "\n".join(b.text for b, gone in zip(blocks, away) if not gone)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row; null html counts as empty.

    Repeated rows and rows without an id each have their row; a table without rows gives none.
    Pages are independent: no shuffle, and one page in memory at a time beside its batch.
    """
    rows = pages.select(F.col("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def each(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(each, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
