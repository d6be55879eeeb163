"""Main text of web pages by a minimum cut over their blocks.

A page becomes blocks of text, each with its place in the element tree. A linear classifier
(the fixed weights below) gives each block log-odds of being content; its size is the
capacity to the content terminal (if positive) or to the boilerplate terminal. Blocks next to
each other, and blocks of one container (through a node for the container), are joined by smoothness
edges that grow with their closeness in the tree. The maximum flow between the terminals
separates content from boilerplate at the least total cost.

Each page is labelled on its own inside a Spark task. Defined results: a null or empty html,
and one without content, give an empty text; markup that is broken is read as far as it goes (an
element ends with its parent, an unclosed script or comment runs to the end); repeated
rows are read each.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from qualia.llm.shared import ship

# Fixed values of HTML: elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe noembed noframes xmp head".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody tfoot thead tr ul".split())
CELL = frozenset("br td th".split())
ENDS_P = BLOCK - frozenset("option legend caption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements, roles and words of class or id that speak for or against content.
CONTENT_TAGS = frozenset("article main".split())
BOILERPLATE_TAGS = frozenset("nav aside footer header form menu dialog search button select label option fieldset".split())
CONTENT_ROLES = frozenset("main article".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form tablist".split())
CONTENT_WORDS = frozenset("article content post entry story main".split())
BOILERPLATE_WORDS = frozenset("ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner sidebar side rail menu nav navbar navigation "
                              "navigate breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay "
                              "share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination pager widget "
                              "copyright disclaimer tags toc skip".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond discussion".split())
COMMENT_LISTS = COMMENT_WORDS - frozenset("reply respond discussion".split())
#: Words that make a class or id tell what the page has, not what the element is: no-sidebar, comments-open.
STATE_WORDS = frozenset("no not has have with without open opened closed enabled disabled allowed off layout template".split())
#: Elements whose class or id never speaks against their text.
WHOLE_TAGS = frozenset("html body main article".split())
#: How firmly an element speaks against its text, and so what makes content of a part of it: any container called content; an article
#: or one whose id says content; the main element; nothing, but other elements may still say worse; nothing.
LOOSE, NAMED, COMMENTS, ASIDE, HIDDEN = range(5)
ASIDE_TAGS = frozenset("nav aside menu dialog".split())
ASIDE_ROLES = frozenset("navigation complementary dialog alertdialog menu menubar".split())
LOOSE_TAGS = frozenset("form fieldset".split())

# The classifier's weights: log-odds of content. What elements say of their text weighs about as much as the text itself; only what the
# contract of a main text rules out (reader comments, hidden elements) is beyond the reach of neighbours.
WEIGHTS = {"bias": -0.5, "word": 0.08, "words_most": 2.0, "sentence": 1.0, "links": -4.0, "heading": 0.5,
           "content": 2.0, "boilerplate": -4.5, "article_header": 1.0, "banned": -40.0}
#: Smoothness, in the same units: neighbours with the same parent, with other parents (shared by distance), block and container, container and parent.
SAME_PARENT, NEIGHBOUR, IN_CONTAINER, CONTAINERS = 1.2, 0.8, 0.8, 0.4

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_MARK = re.compile(r"[>\"']")
_ATTR = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/>"']+)""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?…。][\"'”»)]*(?:\s|$)")
_RAW_END: dict[str, re.Pattern] = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


#: Elements that others end, the elements that each of them ends, and those beyond which none is looked for.
_CLOSABLE = frozenset("p li dt dd tr td th option".split())
_ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_KEEPS = frozenset("ul ol menu dl table select article section div nav body main aside blockquote form button".split())
_CONTAINERS = BLOCK - frozenset("p li tr option legend summary caption dt dd".split()) - HEADING


class _Element:
    __slots__ = ("tag", "parent", "depth", "hint", "firm", "link", "heading", "number", "near", "box")

    def __init__(self, tag: str, parent: "_Element | None", hint: tuple[str, int], number: int):
        self.tag, self.parent, self.number = tag, parent, number
        self.hint, self.firm = hint
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or bool(parent and parent.link)
        self.heading = tag in HEADING or bool(parent and parent.heading)
        #: the element itself or the nearest around it that may end without an end tag or keeps others from it; that is a container
        self.near = self if parent is None or tag in _CLOSABLE or tag in _KEEPS else parent.near
        self.box = self if parent is None or tag in _CONTAINERS else parent.box


def _hint(tag: str, attrs: str, parent: str, firm: int) -> tuple[str, int]:
    """What an element says of its text, given what its parent says: content, boilerplate, article_header, banned or nothing;
    and how firmly, if that is boilerplate or banned."""
    if firm == HIDDEN:
        return parent, firm
    own, own_firm, lifts = "", LOOSE, LOOSE
    words: set[str] = set()
    if attrs and "=" in attrs or "hidden" in attrs:
        a = {(m[1] or m[5]).lower(): next((x for x in m.groups()[1:4] if x is not None), "") for m in _ATTR.finditer(attrs)}
        style = a.get("style", "").replace(" ", "").lower()
        if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
            return "banned", HIDDEN
        names = [(k, {w.lower() for w in _WORDS.findall(x)}) for k in ("class", "id") if k in a for x in _html.unescape(a[k]).split()]
        names = [(k, w) for k, w in names if w and not w & STATE_WORDS and not ("page" in w and w & COMMENT_WORDS)]
        words = {x for _, w in names for x in w}
        role = a.get("role", "").lower()
        called = any(w <= CONTENT_WORDS for _, w in names)
        if words & COMMENT_WORDS and tag not in WHOLE_TAGS:
            own, own_firm = "banned", LOOSE if called else COMMENTS if words & COMMENT_LISTS else NAMED
        elif role in BOILERPLATE_ROLES:
            own, own_firm = "boilerplate", ASIDE if role in ASIDE_ROLES else NAMED
        elif words & BOILERPLATE_WORDS and tag not in WHOLE_TAGS:
            own, own_firm = "boilerplate", NAMED if not called and any(w <= BOILERPLATE_WORDS for _, w in names) else LOOSE
        elif role in CONTENT_ROLES or words & CONTENT_WORDS:
            own = "content"
            if role in CONTENT_ROLES:
                lifts = COMMENTS if role == "main" else NAMED
            elif any(k == "id" and w <= CONTENT_WORDS for k, w in names):
                lifts = NAMED
    below = parent in ("boilerplate", "banned")
    if tag in CONTENT_TAGS and own in ("", "content"):
        own, lifts = "content", COMMENTS if tag == "main" else max(lifts, NAMED)
    elif tag == "header" and parent in ("content", "article_header") and own != "banned":
        return "article_header", LOOSE
    elif tag in BOILERPLATE_TAGS:
        own = own if own == "banned" else "boilerplate"
        own_firm = max(own_firm, ASIDE if tag in ASIDE_TAGS else LOOSE if tag in LOOSE_TAGS else NAMED)
    if own in ("boilerplate", "banned"):
        return "banned" if "banned" in (own, parent) else own, max(own_firm, firm if below else LOOSE)
    if below and own == "content":
        if tag != "main" and words & BOILERPLATE_WORDS:
            lifts = LOOSE
        if lifts < firm or parent == "banned" and tag != "main" and words & COMMENT_WORDS:
            return parent, firm
    return (own, LOOSE) if own else (parent, firm)


def blocks(page: str) -> list[tuple[str, int, int, _Element]]:
    """(text, words, words in links, element) of each block, in page order."""
    out: list = []
    root = top = _Element("", None, ("", LOOSE), 0)
    made = 1
    parts: list[tuple[str, bool]] = []
    home = root

    def close() -> None:
        nonlocal parts
        if parts:
            text = "".join(p for p, _ in parts)
            text = " ".join((_html.unescape(text) if "&" in text else text).split())
            if text:
                n = text.count(" ") + 1
                linked = sum(len(p.split()) for p, link in parts if link)
                out.append((text, n, min(linked, n), home))
            parts = []

    def add(text: str) -> None:
        nonlocal home
        if text:
            if not parts:
                home = top
            elif not text.isspace() and all(p.isspace() for p, _ in parts):
                home = top
            parts.append((text, top.link))

    at, n = 0, len(page)
    unclosed: set[str] = set()  # quote marks that do not occur any more
    open_tags: Counter = Counter()

    def tag_end(at: int) -> int:
        """The place of the > that ends a tag, or the page's end; quoted values are passed over, each place is looked at once."""
        while m := _MARK.search(page, at):
            q, at = m[0], m.end()
            if q == ">":
                return at - 1
            if page[m.start() - 1] == "=" or page[:m.start()][-20:].rstrip().endswith("="):
                end = -1 if q in unclosed else page.find(q, at)
                if end < 0:
                    unclosed.add(q)
                else:
                    at = end + 1
        return n

    def leave(e: _Element) -> None:
        """Everything up to and with e ends."""
        nonlocal top
        while True:
            open_tags[top.tag] -= 1
            done = top is e
            top = top.parent
            if done:
                return

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        m = _OPEN.match(page, lt)
        if not m:
            add("<")
            at = lt + 1
            continue
        if m[5] is None:
            end = "-->" if m[1] else "]]>" if m[2] else ">"
            at = page.find(end, m.end())
            at = n if at < 0 else at + len(end)
            continue
        tag = m[5].lower()
        gt = tag_end(m.end())
        attrs = page[m.end():gt]
        at = min(gt + 1, n)
        whole = attrs.endswith("/")
        if m[4]:
            if tag == "p" or tag in BLOCK:
                close()
            elif tag in CELL:
                add(" ")
            if open_tags[tag] > 0:
                e = top
                while e.tag != tag:
                    e = e.parent
                leave(e)
            continue
        if tag in BLOCK:
            close()
        elif tag in CELL:
            add(" ")
        if tag in RAW and tag != "head":
            if not whole:
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else n
            continue
        if tag in VOID or whole and tag not in BLOCK:
            continue
        # elements whose end may be left out
        if tag in ENDS_P or tag in _CLOSABLE:
            ends = _ENDS.get(tag, frozenset()) | ({"p"} if tag in ENDS_P else frozenset())
            e, cut = top.near, None
            while e is not root and e.tag not in _KEEPS:
                if e.tag in ends:
                    cut = e
                e = e.parent.near
            if cut is not None:
                leave(cut)
        top = _Element(tag, top, _hint(tag, attrs, top.hint, top.firm), made)
        open_tags[tag] += 1
        made += 1
    close()
    return out


def log_odds(words: int, linked: int, text: str, e: _Element) -> float:
    w = WEIGHTS
    score = w["bias"] + min(w["word"] * words, w["words_most"]) + w["links"] * linked / words
    if _SENTENCE.search(text):
        score += w["sentence"]
    if e.heading:
        score += w["heading"]
    return score + w.get(e.hint, 0.0)


def _distance(a: _Element, b: _Element) -> int:
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def graph(found: list[tuple[str, int, int, _Element]]) -> tuple[list[float], dict[tuple[int, int], float]]:
    """(log-odds of each node, capacity of each edge): the blocks, then their containers."""
    odds = [log_odds(n, linked, text, e) for text, n, linked, e in found]
    edges: dict[tuple[int, int], float] = {}
    place: dict[int, int] = {}

    def node(e: _Element) -> int:
        way: list[int] = []  # the container and those around it, up to the first that was known
        while True:
            k = place.get(e.number)
            known = k is not None
            if not known:
                k = place[e.number] = len(odds)
                odds.append(0.0)
            way.append(k)
            if known or e.parent is None or e.parent.parent is None:
                break
            e = e.parent.box
            if e.parent is None:
                break
        for k in range(len(way) - 1, 0, -1):
            join(way[k - 1], way[k], CONTAINERS)
        return way[0]

    def join(a: int, b: int, capacity: float) -> None:
        key = (a, b) if a < b else (b, a)
        edges[key] = edges.get(key, 0.0) + capacity

    for k, (_, _, _, e) in enumerate(found):
        if k:
            d = _distance(found[k - 1][3], e)
            join(k - 1, k, SAME_PARENT if d <= 2 and found[k - 1][3].parent is e.parent else NEIGHBOUR / max(d, 1))
        c = e.box
        if c.parent is not None:
            join(k, node(c), IN_CONTAINER)
    return odds, edges


def min_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """For each node whether it is on the content side of a minimum cut (an edge costs its capacity if cut).

    A node whose terminal outweighs all its edges takes that side in some minimum cut; it is
    fixed and its edges become terminal capacity of its neighbours. The rest goes through
    blocking flows along shortest paths.
    """
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    side: list = [None] * n
    todo = list(range(n))
    while todo:
        a = todo.pop()
        if side[a] is None and abs(odds[a]) >= sum(near[a].values()) and (odds[a] or not near[a]):
            side[a] = odds[a] > 0
            for b, c in near[a].items():
                odds[b] += c if side[a] else -c
                del near[b][a]
                todo.append(b)
            near[a] = {}
    left = [a for a in range(n) if side[a] is None]
    if not left:
        return side
    # arcs in pairs, each the other's reverse; terminals come last
    place = {a: k for k, a in enumerate(left)}
    source, sink = len(left), len(left) + 1
    arcs: list[list[int]] = [[] for _ in range(len(left) + 2)]
    to: list[int] = []
    cap: list[float] = []

    def arc(a: int, b: int, there: float, back: float) -> None:
        arcs[a].append(len(to))
        arcs[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((there, back))

    for a in left:
        for b, c in near[a].items():
            if a < b:
                arc(place[a], place[b], c, c)
        if odds[a] > 0:
            arc(source, place[a], odds[a], 0.0)
        elif odds[a] < 0:
            arc(place[a], sink, -odds[a], 0.0)
    tiny = 1e-9
    while True:  # a blocking flow along shortest paths, again and again (no path is looked for twice in a round)
        level = {source: 0}
        row = [source]
        while row and sink not in level:
            later = []
            for a in row:
                for x in arcs[a]:
                    if cap[x] > tiny and to[x] not in level:
                        level[to[x]] = level[a] + 1
                        later.append(to[x])
            row = later
        if sink not in level:
            break
        tried = [0] * len(arcs)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(cap[x] for x in path)
                for x in path:
                    cap[x] -= flow
                    cap[x ^ 1] += flow
                first = next(k for k, x in enumerate(path) if cap[x] <= tiny)
                at = to[path[first] ^ 1]
                del path[first:]
                continue
            while tried[at] < len(arcs[at]):
                x = arcs[at][tried[at]]
                if cap[x] > tiny and level.get(to[x]) == level[at] + 1:
                    break
                tried[at] += 1
            if tried[at] < len(arcs[at]):
                path.append(arcs[at][tried[at]])
                at = to[path[-1]]
            elif path:
                x = path.pop()
                at = to[x ^ 1]
                tried[at] += 1
            else:
                break
    for a in left:
        side[a] = place[a] in level
    return side


def main_text(page: str | None) -> tuple[str, int, int]:
    """(text, blocks in it, blocks on the page)."""
    found = blocks(page or "")
    if not found:
        return "", 0, 0
    side = min_cut(*graph(found))
    kept = [text for (text, *_), s in zip(found, side) if s]
    return "\n\n".join(kept), len(kept), len(found)


def _extractor(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                got = [main_text(x.as_py()) for x in part.column(at)]
                others = [(n, c) for k, (n, c) in enumerate(zip(part.schema.names, part.columns)) if k != at]
                yield pa.RecordBatch.from_arrays(
                    [c for _, c in others] + [pa.array([g[0] for g in got], pa.string()), pa.array([len(g[0]) for g in got], pa.int64()),
                                              pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())],
                    [n for n, _ in others] + list(ADDED.names))
    return run


ADDED = T.StructType([T.StructField("main_text", T.StringType()), T.StructField("main_chars", T.LongType()),
                      T.StructField("main_blocks", T.LongType()), T.StructField("page_blocks", T.LongType())])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``main_text``, its code points, its blocks and the page's blocks."""
    ship(pages.sparkSession)
    pages = pages.drop(*ADDED.names)  # columns so named are replaced
    fields = [f for f in pages.schema.fields if f.name != html_col]
    return pages.mapInArrow(_extractor(pages.columns.index(html_col)), T.StructType(fields + ADDED.fields))
