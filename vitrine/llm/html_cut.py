"""Main text of web pages by a minimum cut over their blocks.

A page becomes a row of text blocks, each with the chain of elements around it. A linear classifier gives every
block a log-odds for content, which becomes its capacity from the source (content) or to the sink (boilerplate);
blocks next to each other are tied by edges whose capacity falls with their distance in the element tree. The blocks
on the source's side of the minimum cut are the text. Capacities are integers, so results don't depend on the machine.

Names and forms speak against what is inside them, but not if that is most of the page's running text: see
``void_wrappers``.
"""

from __future__ import annotations

import heapq
import html
import re
from collections import Counter, deque

from pyspark.sql import DataFrame

from vitrine.llm.core import small_batches

# Kinds of elements in HTML.
BLOCK = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object"
    " ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul video audio"
    " math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag of the left closes an open element of the right, unless one of the bounds stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}

# The classifier: log-odds in quarters. Element, role and name evidence counts once for a chain, the strongest first.
NEVER = -80
DROPPED = frozenset("nav aside noscript template svg math button select option fieldset dialog menu footer object"
                    " video audio canvas search".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar tablist toolbar"
    " status tooltip".split())
BAD_NAMES = re.compile(
    r"ad|ads|adv|adverts?|advertis\w*|adsense|adslot|sponsor\w*|promo\w*|banner\w*|cookies?\w*|consent|gdpr|notices?|alerts?"
    r"|nav\w*|menus?|breadcrumbs?|sidebar\w*|aside|rail|footer\w*|masthead|comments?|commentlist|disqus|repl(?:y|ies)|respond"
    r"|share|sharing|social|related|recommend\w*|trending|popular|newsletter|subscri\w*|signup|login|popup|modal|overlay|toolbar"
    r"|pagination|pager|widgets?|disclaimers?|copyright|search|skip|toc|tags|tagcloud|outbrain|taboola")
# Of these, what an article element of its own can be.
BAD_ARTICLES = re.compile(
    r"ad|ads|adv|adverts?|advertis\w*|sponsor\w*|promo\w*|comments?|repl(?:y|ies)|related|sidebar\w*|newsletter|widgets?")
HEAD_NAMES = re.compile(r"header\w*|topbar|branding|logo")
GOOD_NAMES = re.compile(r"article\w*|content|main|post|entry|story|body|text|prose|blogpost")
LISTS = frozenset("ul ol menu dir dl".split())
LAYOUT = frozenset("has no with without is layout".split())  # names that tell of a part elsewhere, as has-sidebar
PROSE = 40  # code points of a block that counts as running text
WHOLE_FORM = 400  # running text of a form that holds a page
SHARE = 4  # a wrapper has this many times the running text that nothing speaks against
TIE, FAR_TIE = 24, 8  # capacity of an edge to the next and to the next but one, for blocks of one parent

# A quote delimits a value after an equals sign only; any other doesn't keep a tag open.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SENTENCE = re.compile(r"[.!?…。]['\"»”)]*$")


class Element:
    """An open element: its evidence joined with that of its ancestors.

    ``doubt``: the nearest element, this one included, that a name or being a form speaks against. Of such an element:
    ``above``, the next one around it; ``named``, another name speaks for it; ``title``, the page's first h1 or a void named
    one is in it; ``marked``, an article element is; ``prose``, its running text; ``void``, it is a wrapper and no longer counts.
    """

    __slots__ = ("tag", "parent", "depth", "bad", "good", "listed", "heading", "inside", "doubt", "above", "named", "title",
                 "marked", "prose", "void")

    def __init__(self, tag: str, parent: Element | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.bad, self.good = (parent.bad, parent.good) if parent else (0, 0)
        self.listed = tag in LISTS or bool(parent and parent.listed)
        self.heading = tag in HEADING or bool(parent and parent.heading)
        self.inside = tag in ("article", "main") or bool(parent and parent.inside)
        self.doubt = self.above = parent.doubt if parent else None
        self.named = self.title = self.marked = self.void = False
        self.prose = 0
        if tag in DROPPED:
            self.bad = NEVER
        elif tag == "form":
            self.doubt = self
        elif tag == "header" and not (parent and parent.inside):
            self.bad = NEVER
        elif tag in ("article", "main"):
            self.good = max(self.good, 16)
            if tag == "main":
                self.bad, self.doubt = 0, None
        if attributes and not attributes.isspace() and tag not in ("html", "body"):
            self._attributes(attributes)
        if self.doubt and self.doubt is not self and tag == "article":
            self.doubt.marked = True

    def _attributes(self, text: str) -> None:
        got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}
        role = got.get("role", "").lower()
        style = got.get("style", "").replace(" ", "").lower()
        if role in DROPPED_ROLES or "hidden" in got or got.get("aria-hidden", "").lower() == "true" or (
                "display:none" in style or "visibility:hidden" in style):
            self.bad = NEVER
        if role in ("main", "article"):
            self.inside, self.good = True, max(self.good, 16)
        whole = self.tag in ("article", "main")
        for name in f"{got.get('class', '')} {got.get('id', '')}".split():
            parts = [p.lower() for p in NAME_PARTS.findall(name)]
            if not parts or not LAYOUT.isdisjoint(parts):
                continue
            good = any(GOOD_NAMES.fullmatch(p) for p in parts)
            if BAD_ARTICLES.fullmatch(parts[0]) if whole else any(BAD_NAMES.fullmatch(p) for p in parts):
                self.doubt = self
            elif not whole and not self.inside and any(HEAD_NAMES.fullmatch(p) for p in parts) and not self.heading and not good:
                self.doubt = self
            elif good:
                self.good, self.named = max(self.good, 10), True


class Block:
    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: Element, linked: int):
        self.text, self.element, self.linked = text, element, linked


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order; text between two block-level tags is one block."""
    blocks: list[Block] = []
    top = Element("", None, "")
    open_: list[Element] = [top]
    named: Counter[str] = Counter()  # open elements by tag: an end tag without one costs nothing
    parts: list[str] = []
    linked = at = 0
    link_depth = -1  # open elements when the current link began; -1 outside links

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append(Block(text, open_[-1], linked))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if link_depth >= 0:
            linked += len(text.strip())

    def close(k: int) -> None:
        nonlocal link_depth
        named.subtract(e.tag for e in open_[k:])
        del open_[k:]
        if link_depth > len(open_):
            link_depth = -1

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[3] is None:
            if m[1]:
                add(m[1])
            continue
        tag = m[3].lower()
        if m[2]:
            if tag in BLOCK:
                if named[tag]:
                    k = len(open_) - 1
                    while open_[k].tag != tag:
                        k -= 1
                    flush()
                    close(k)
                elif tag == "p":
                    flush()
            elif tag == "a":
                link_depth = -1
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "hr":
            flush()
        elif tag == "a":
            link_depth = len(open_)
        if tag in VOID or tag not in BLOCK:
            continue
        flush()
        k = len(open_) - 1
        if tag in CLOSES:
            which, bounds = CLOSES[tag]
            lowest, left = None, sum(named[t] for t in which)
            while left and open_[k].tag not in bounds:
                if open_[k].tag in which:
                    lowest, left = k, left - 1
                k -= 1
            if lowest:
                close(lowest)
        else:
            while k and open_[k].tag in HEADING | {"p"}:
                if open_[k].tag == "p" or tag in HEADING:
                    close(k)
                    break
                k -= 1
        if not m[4].rstrip().endswith("/") or tag not in ("svg", "math"):
            open_.append(Element(tag, open_[-1], m[4]))
            named[tag] += 1
    flush()
    return blocks


def void_wrappers(blocks: list[Block]) -> None:
    """Makes names and forms void that are around the article rather than beside it.

    Such an element has most of the page's running text, and it bears a second name that speaks for it, holds the page's
    title or, if nothing outside is marked as article or title, an article element; or it is a form of some length.
    What speaks against elements inside it stands. Named and titled ones are looked at first, those with most text before others.
    """
    clean = article = 0
    first, titled, doubted = True, False, {}
    for b in blocks:
        e, n = b.element, len(b.text)
        if e.bad <= NEVER:
            continue
        if first and e.tag == "h1":
            first = False
            if e.doubt:
                e.doubt.title = True
                doubted.setdefault(e.doubt, len(doubted))
            else:
                titled = True
        if n >= PROSE and 4 * b.linked <= n:
            if e.doubt:
                e.doubt.prose += n
                doubted.setdefault(e.doubt, len(doubted))
            else:
                clean += n
                if e.inside or e.good >= 10:
                    article += n

    def turn(d: Element) -> tuple:
        return not (d.named or d.title), -d.prose, doubted.setdefault(d, len(doubted)), d

    waiting = [turn(d) for d in doubted]
    heapq.heapify(waiting)
    while waiting:
        weak, prose, _, d = heapq.heappop(waiting)
        if d.void or -prose != d.prose or not d.prose or SHARE * clean > d.prose:
            continue
        if weak and not (d.marked and not article and not titled or d.tag == "form" and d.prose >= WHOLE_FORM):
            continue
        d.void = True
        if d.above is None:
            clean += d.prose
            article += d.prose
            titled = titled or d.title
        else:
            up = d.above
            up.prose += d.prose
            up.title, up.marked = up.title or d.title or d.named, up.marked or d.marked
            heapq.heappush(waiting, turn(up))


def doubtful(e: Element) -> bool:
    """Something stands that speaks against the element or one around it."""
    d, passed = e.doubt, []
    while d is not None and d.void:
        passed.append(d)
        d = d.above
    for x in passed:
        x.above = d
    return d is not None or e.bad <= NEVER


def log_odds(block: Block, marked: bool) -> int:
    """Evidence for content in quarters; ``marked``: the page says elsewhere which part is the article."""
    e, text = block.element, block.text
    n = len(text)
    if doubtful(e):
        return NEVER
    x = e.good
    if marked and not e.inside and e.good < 10:
        x -= 20
    density = block.linked / n
    if density > 0.5 and not e.heading:
        x -= 20 if e.listed or not e.inside else 8
    elif density > 0.25:
        x -= 4
    x += 8 if n >= 80 else 4 if n >= 40 else -2 if n < 20 else 0
    if SENTENCE.search(text):
        x += 4
    if e.heading:
        x += 3
    elif e.listed:
        x -= 2
    if "©" in text and n < 200 and not e.inside:
        x -= 24
    return x


def distance(a: Element, b: Element) -> int:
    """Steps between two elements of the tree; ``TIE`` or more is too far for an edge, however far."""
    steps = 0
    while a is not b and steps < TIE:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(odds: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of the smallest minimum cut.

    A positive number is a capacity from the source, a negative one to the sink; edges (i, j, capacity) go both ways.
    Nodes whose own capacity outweighs all their edges are settled first; the rest is solved by augmenting along
    shortest paths, level by level.
    """
    n = len(odds)
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for i, j, c in edges:
        if c > 0:
            near[i].append((j, c))
            near[j].append((i, c))
    weight, side = list(odds), [None] * n
    loose = [sum(c for _, c in near[i]) for i in range(n)]
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is None and (weight[i] > loose[i] or weight[i] <= -loose[i]):
            side[i] = weight[i] > loose[i]
            for j, c in near[i]:
                if side[j] is None:
                    weight[j] += c if side[i] else -c
                    loose[j] -= c
                    queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        source, sink = len(rest), len(rest) + 1
        graph: list[list[int]] = [[] for _ in range(len(rest) + 2)]
        to: list[int] = []
        room: list[int] = []

        def link(a: int, b: int, forth: int, back: int) -> None:
            graph[a].append(len(to))
            to.append(b)
            room.append(forth)
            graph[b].append(len(to))
            to.append(a)
            room.append(back)

        for i in rest:
            if weight[i] > 0:
                link(source, number[i], weight[i], 0)
            elif weight[i] < 0:
                link(number[i], sink, -weight[i], 0)
            for j, c in near[i]:
                if j > i and side[j] is None:
                    link(number[i], number[j], c, c)
        while True:
            level = [-1] * (len(rest) + 2)
            level[source] = 0
            line = deque([source])
            while line:
                a = line.popleft()
                for e in graph[a]:
                    if room[e] and level[to[e]] < 0:
                        level[to[e]] = level[a] + 1
                        line.append(to[e])
            if level[sink] < 0:
                break
            turn, path, a = [0] * (len(rest) + 2), [], source
            while True:
                if a == sink:
                    flow = min(room[e] for e in path)
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, a = [], source
                    continue
                while turn[a] < len(graph[a]):
                    e = graph[a][turn[a]]
                    if room[e] and level[to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                else:
                    if a == source:
                        break
                    a = to[path.pop() ^ 1]
                    turn[a] += 1
                    continue
                path.append(e)
                a = to[e]
        for i in rest:
            side[i] = level[number[i]] >= 0
    return side


def main_text(page: str | None) -> str:
    """The text blocks on the content side, joined by newlines."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    void_wrappers(blocks)
    marked = any(b.element.inside and not doubtful(b.element) for b in blocks)
    odds = [log_odds(b, marked) for b in blocks]
    edges = []
    for i in range(len(blocks) - 1):
        edges.append((i, i + 1, TIE // (1 + distance(blocks[i].element, blocks[i + 1].element))))
        if i + 2 < len(blocks):
            edges.append((i, i + 2, FAR_TIE // (1 + distance(blocks[i].element, blocks[i + 2].element))))
    side = minimum_cut(odds, edges)
    return "\n".join(b.text for b, content in zip(blocks, side) if content)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row: the article's text, whole.

    Null and empty pages give an empty text. Each row is read on its own, so repeated rows give equal texts;
    columns other than page_id, url and html are not read.
    """
    small_batches(pages.sparkSession)

    def texts(batches):
        import pyarrow as pa

        for batch in batches:
            out = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                 pa.array(map(len, out), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
