"""Main text of web pages by composite text density.

A page is cut into tags and text once, and its DOM is built with the usual
implied end tags.  Parts that are never main text (menus, page headers, footers,
sidebars, adverts, notices, forms, scripts, styles, comments of readers) are
marked, by element or by a word of ``class``, ``id`` or ``role``, and not chosen, however
long they are.  Those marked by element count towards the density of the page.

Wrappers are called by such words too.  Names that only say whether something is there
(``has-sidebar``, ``comments-open``) mark nothing, and a name with a word for a wrapper
(``content-sidebar-wrap``) marks nothing if the thing itself lies inside.  If no ``article`` or
``main`` is left outside the marked parts but one lies inside them, they are looked into where that
gives the longer text; and if nothing at all is found, first the outermost parts marked by words
and then all of them are looked into.  What is marked further inside stays out.

For every node,

    density = C / T * log_b((C / LC) * (T / LT)),
    b = ln((C / (C - LC)) * LC + (LCb / Cb) * C + e)

with C characters, T tags, LC and LT those within links, and b as index for the
body; zero divisors count as one, and b is at least 2 (pages without links). Text
that comes out at zero without being all links keeps a trace of density.  The node whose children's densities add up to
the most is the centre of the article (a node that adds less than a twentieth to its best part gives way to it).  The smallest density on the path from
there to the body is the threshold: going down from the body, every branch of at
least that density gives its own subtree of the largest sum.  A chosen subtree
inside an ``article`` or ``main`` element stands for that element, and one with a
heading before it under the same parent takes the heading along.  Their blocks,
in page order, are the text.

White space inside a block becomes one space; blocks are joined by an empty
line.  ``br`` is white space.  A page without text (or a null one) gives the
empty text.  Pages without a body count as one.  Each row gives a row, repeated ones
too, and an empty table an empty one.  The work grows with a page's length, whatever its
markup: a tag that never ends stops at the next ``<``.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.base import load, query
from tabloom.session import with_code

_COMMENT = r"<!--.*?(?:-->|\Z)"
_TOKEN = re.compile(
    _COMMENT
    + r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|(?P<endless></?[a-zA-Z])",
    re.DOTALL,
)
# After a tag that does not end: quotes mean nothing, and tags end where others begin.
_PLAIN_TOKEN = re.compile(
    _COMMENT + r"|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>?|<[!?][^<>]*+>?", re.DOTALL
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CUT = frozenset("head nav footer aside form menu dialog button select label".split()) | RAW

# What a start tag closes, if that element is open inside the nearest of the scopes.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "body": ({"head"}, {"html"}),
}

# Words of class, id or role by which a part is not main text.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments disqus cookie cookies consent footer menu nav navbar navigation newsletter notice "
    "popup promo promoted related share sharing sidebar social sponsor sponsored subscribe "
    "toolbar widget masthead modal overlay pagination pager complementary contentinfo alert "
    "responses replies".split()
)
HEADS = frozenset({"header"})
# Words that make a name one of a state, and words that make it one of a wrapper.
STATES = frozenset("has no with without is not hide show open opened closed enabled disabled active allowed".split())
WRAPPERS = frozenset("wrap wrapper container content main layout page outer inner grid row body site area".split())
WRAPS, NAMED, SURE = 1, 2, 3
MARGIN = 1.05
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "noise", "words", "link", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: int = 0, words: frozenset[str] = frozenset()):
        self.tag, self.parent, self.noise, self.words, self.cut = tag, parent, noise, words, 0
        self.parts: list[Node | str] = []
        self.link = tag == "a"


def _noise(tag: str, attributes: str, inside_article: bool) -> tuple[int, frozenset[str]]:
    """``SURE`` if an element is never main text, ``NAMED`` if a word says so, ``WRAPS`` if a wrapper's name does, else 0.

    Also the words that say so, without a plural s.
    """
    if tag in CUT or (tag in HEADS and not inside_article):
        return SURE, frozenset()
    if not attributes or tag in ("body", "html", "main"):
        return 0, frozenset()
    named, said = 0, set()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return SURE, frozenset()
        if name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return SURE, frozenset()
            continue
        for one in value.split():
            words = {w.lower() for w in _WORDS.findall(one)}
            found = words & NOISE or (words & HEADS if not inside_article else set())
            if not found or words & STATES:
                continue
            said |= {w.rstrip("s") for w in found}
            named = NAMED if named == NAMED or not words & WRAPPERS else WRAPS
    return named, frozenset(said)


class _Open:
    """The elements that are open, with the places of each tag among them."""

    def __init__(self, root: Node):
        self.nodes, self.at = [root], {root.tag: [0]}
        self.blocks = [0]

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags) -> int:
        """The place of the innermost element with one of some tags; 0 for none (the root has place 0)."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def close(self, place: int) -> None:
        """Close the element at a place, and all inside."""
        while len(self.nodes) > place > 0:
            node = self.nodes.pop()
            self.at[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()


def _tokens(page: str) -> Iterator[re.Match]:
    for m in _TOKEN.finditer(page):
        if m["endless"]:
            yield from _PLAIN_TOKEN.finditer(page, m.start())
            return
        yield m


def parse(page: str) -> Node:
    """The DOM of a page: nodes, with text as strings between them."""
    root = Node("html", None)
    open_, at = _Open(root), 0
    size = len(page)
    for m in _tokens(page):
        start = m.start()
        if start < at:
            continue
        if start > at:
            open_.nodes[-1].parts.append(page[at:start])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            open_.close(open_.last([tag]))
            continue
        if tag == "html":
            continue
        if tag in BLOCK and open_.at.get("p") and open_.at["p"][-1] == open_.blocks[-1]:
            # An open paragraph ends where a block begins.
            open_.close(open_.blocks[-1])
        if tag in CLOSES:
            closed, scope = CLOSES[tag]
            inside = open_.last(scope)
            if tag == "tr":  # with the row's cells
                places = [p for t in closed for p in open_.at.get(t, ()) if p > inside]
                open_.close(min(places, default=0))
            elif (place := open_.last(closed)) > inside:
                open_.close(place)
        up = open_.nodes[-1]
        node = Node(tag, up, *_noise(tag, m[3], open_.last(("article", "main")) > 0))
        node.link = node.link or up.link
        up.parts.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        open_.push(node)
    if at < size:
        open_.nodes[-1].parts.append(page[at:])
    return root


def _order(root: Node) -> list[Node]:
    """All nodes but scripts and the like and parts marked by words, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo += [p for p in node.parts if isinstance(p, Node) and p.tag not in RAW and p.cut != NAMED]
    return found


def _all_nodes(root: Node) -> list[Node]:
    """All nodes, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo += [p for p in node.parts if isinstance(p, Node)]
    return found


def _children(node: Node) -> list[Node]:
    """Child nodes that may be main text."""
    return [p for p in node.parts if isinstance(p, Node) and not p.cut]


def _measure(order: list[Node]) -> None:
    for node in order:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
    for node in reversed(order):
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.chars += own
        if node.link:
            node.link_chars, node.link_tags = node.chars, node.tags
        if node is not order[0]:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")


def _weigh(order: list[Node], body: Node) -> None:
    share = body.link_chars / max(body.chars, 1)
    for node in order:
        c, t = node.chars, max(node.tags, 1)
        lc, lt = node.link_chars, max(node.link_tags, 1)
        if not c:
            node.density = 0.0
            continue
        base = max(math.log(c / max(c - lc, 1) * lc + share * c + math.e), 2.0)
        node.density = c / t * max(math.log(c / max(lc, 1) * (t / lt), base), 0.0)
        if not node.density and lc < c:
            node.density = 1e-9 * c
    for node in order:
        node.total = 0.0
    for node in reversed(order):
        if node.total == 0.0:
            node.total = node.density
        if node is not order[0]:
            node.parent.total += node.density


def _settle_wrappers(order: list[Node]) -> None:
    """A wrapper's name marks it unless the thing it names lies inside; ``order`` has parents first."""
    inside: dict[int, set[str]] = {}
    for node in reversed(order):
        own = inside.pop(id(node), set())
        if node.noise == WRAPS and not node.words <= own:
            node.noise = NAMED
        if node.noise == NAMED:
            own = own | node.words
        if node.parent is not None and own:
            inside.setdefault(id(node.parent), set()).update(own)


def _mark(order: list[Node], spared: set[int]) -> None:
    """Mark the parts that are never main text, but for those ``spared``; ``order`` has parents first."""
    order[0].cut = 0
    for node in order[1:]:
        named = node.noise == NAMED and id(node) not in spared
        node.cut = node.parent.cut or (SURE if node.noise == SURE else NAMED if named else 0)


def _plain_articles(order: list[Node]) -> list[Node]:
    """``article`` and ``main`` elements that are not marked themselves or by an element around them."""
    sure: dict[int, bool] = {id(order[0]): False}
    for node in order[1:]:
        sure[id(node)] = sure[id(node.parent)] or node.noise == SURE
    return [n for n in order[1:] if n.tag in ("article", "main") and n.noise == 0 and not sure[id(n)]]


def _body(root: Node) -> Node:
    return next((p for p in root.parts if isinstance(p, Node) and p.tag == "body"), root)


def _centres(body: Node) -> set[int]:
    """Nodes whose subtrees are main text."""
    order = _order(body)
    _measure(order)
    _weigh(order, body)
    best: dict[int, Node] = {}
    for node in reversed(order):
        part = max((best[id(p)] for p in _children(node)), key=lambda n: n.total, default=node)
        # What adds next to nothing to its densest part does not take its place.
        best[id(node)] = part if node.total < MARGIN * part.total else node
    top = best[id(body)]
    threshold, node = top.density, top
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    article: dict[int, Node | None] = {id(body): None}  # the nearest one around
    for node in order[1:]:
        article[id(node)] = node if node.tag in ("article", "main") else article[id(node.parent)]
    chosen, taken, todo = set(), set(), [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold and node.density > 0:
            found = best[id(node)]
            todo += _children(node)
            if id(found) in taken:
                continue
            taken.add(id(found))
            chosen.add(id(article[id(found)] or found))
            if found.parent is not None and found is not body:
                around = _children(found.parent)
                before = around[: next(i for i, n in enumerate(around) if n is found)]
                chosen.update(id(n) for n in before if n.tag in HEADINGS)
    return chosen


def main_text(page: str | None) -> str:
    if not page:
        return ""
    body = _body(parse(page))
    order = _all_nodes(body)
    _settle_wrappers(order)
    named = [n for n in order[1:] if n.noise == NAMED]
    _mark(order, set())
    text = _text(body)
    if not named:
        return text
    articles = _plain_articles(order)
    if articles and all(n.cut for n in articles):
        spared = set()
        for node in articles:
            while node is not body and id(node) not in spared:
                spared.add(id(node))
                node = node.parent
        _mark(order, spared)
        inside = _text(body)
        text = max(text, inside, key=len)
    if not text:
        within = {id(body): False}  # whether a node lies inside a named one
        for node in order[1:]:
            within[id(node)] = within[id(node.parent)] or node.parent.noise == NAMED
        outermost = {id(n) for n in named if not within[id(n)]}
        for spared in (outermost, {id(n) for n in named}):
            _mark(order, spared)
            if text := _text(body):
                break
    return text


def _text(body: Node) -> str:
    """The blocks of the chosen parts."""
    chosen = _centres(body)
    if not chosen:
        return ""
    blocks: list[list[str]] = [[]]
    # (node, inside chosen) to enter, or None to end a block.
    todo: list[tuple[Node | str | None, bool]] = [(body, False)]
    while todo:
        part, inside = todo.pop()
        if part is None:
            blocks.append([])
        elif isinstance(part, str):
            if inside:
                blocks[-1].append(part)
        elif not part.cut:
            inside = inside or id(part) in chosen
            if part.tag == "br":
                blocks[-1].append(" ")
            if part.tag in BLOCK:
                blocks.append([])
                todo.append((None, inside))
            todo += [(p, inside) for p in reversed(part.parts)]
    texts = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """The input with its main text added (replacing a column called ``out``); per row."""
    kept = [c for c in pages.columns if c.lower() not in (html_col.lower(), out.lower())]
    at = len(kept)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([main_text(p) for p in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], text], names=[*batch.schema.names[:at], out]
            )

    narrow = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{html_col}`"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:at])
    return with_code(narrow).mapInArrow(extract, f"{schema}{', ' if schema else ''}`{out}` string")


@query("op1_html_main_text")
def op1_html_main_text(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
