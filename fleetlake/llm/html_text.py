"""Main text of web pages by composite text density.

A page becomes a tree of elements. What its tag, role, class or id calls a menu, header,
footer, sidebar, notice, advert, form, script, style or comment section is taken out. For
every element left, the density is its characters per tag, adjusted by how much of the text
stands in links; the sums of the children's densities choose the main subtree. The smallest
density on the way from there up to the body is the threshold. An article element on that way
is read whole, with the headline in its header and its lists of links. Without one, boxes
beside the subtree that are thinner than the threshold go, up to the main element or the body,
and what is as dense stays, as do headings, paragraphs and lists of the boxes around it;
elements that consist of links and are thinner than the threshold go too.

A page costs time in proportion to its length, however deep its elements are.

Defined results: null, empty and unreadable pages give the empty text; rows are judged each
for itself; nothing is cut off at any length; unclosed tags end where HTML ends them, and a tag that the page breaks off in is no text.
"""

from __future__ import annotations

import bisect
import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements that are no part of the main text, whatever they hold.
LEFT_OUT = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input "
    "label iframe object embed svg canvas audio video dialog menu map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Words that mark the same as a class name or id, or as the first or last part of one.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments disqus reply replies respond pagination pager toolbar widget "
    "widgets hidden".split()
)
#: Parts beside a mark that tell of a state or of something else.
STATES = frozenset(
    "no not non without has have with is open opened closed enabled disabled on off allowed free science sciences "
    "overflow visually backface studies work justice security network networks".split()
)
#: Marks of sections that may be longer than the article.
APART = frozenset("comment comments disqus reply replies respond related recommended recommendations".split())
#: Elements that hold blocks and are no text by themselves.
CONTAINERS = frozenset("div section center fieldset details table tbody tr td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle semantics".split()
)
#: What an opening tag closes, up to the nearest of the elements after the colon.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text: of their names only those count that are marks from end to end.
RUNNING = INLINE | HEADINGS | frozenset("p li dt dd blockquote pre td th caption figcaption".split())
#: What is out for good: a section apart, or by its tag, role or state.
FIXED = APART | {"tag", "header"}
_WORDS = re.compile(r"[A-Za-z]+")
#: A tag that the page ends in.
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")


class Element:
    __slots__ = ("tag", "parent", "children", "out", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Element | None, out: str = ""):
        self.tag, self.parent, self.out = tag, parent, out
        self.children: list[Element | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _named(name: str, tag: str) -> str:
    """The mark that one class name or id is, begins or ends with; states and negations are none."""
    words = [w.lower() for w in _WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name))]
    if len(words) > 1 and (STATES.intersection(words) or words[-1] == "hidden"):
        return ""
    if tag in RUNNING and not MARKS.issuperset(words):
        return ""
    return next((w for w in (*words[:1], *words[-1:]) if w in MARKS), "")


def _marked(tag: str, attributes: list[tuple[str, str | None]]) -> str:
    """What leaves an element out: ``tag`` for its tag, role or state, ``header`` for the tag header
    alone, the mark of a class or id, or nothing."""
    if tag in LEFT_OUT and tag != "header":
        return "tag"
    mark = ""
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "tag"
        if name == "role" and (value or "").lower() in ROLES:
            return "tag"
        if name in ("class", "id") and value and tag not in ("body", "html", "article", "main"):
            mark = mark or next(filter(None, (_named(n, tag) for n in value.split())), "")
    if tag == "header":
        return "tag" if mark else "header"
    return mark


def _spare_wrappers(root: Element) -> None:
    """Takes back marks of elements that hold the article: the page's only article or main, or most of its plain text.

    A section of comments or related pages stays out, however long and whatever tags it uses.
    """
    order, stack = [], [(root, False)]
    while stack:
        element, inside = stack.pop()
        order.append((element, inside))
        stack += [] if element.out in FIXED else [(c, inside or bool(element.out)) for c in element.children if isinstance(c, Element)]
    plain: dict[int, int] = {}
    holds: dict[int, bool] = {}
    for element, _ in reversed(order):
        if element.out in FIXED or element.tag == "a":
            plain[id(element)], holds[id(element)] = 0, False
            continue
        nested = [c for c in element.children if isinstance(c, Element)]
        text = sum(len("".join(c.split())) for c in element.children if isinstance(c, str))
        plain[id(element)] = text + sum(plain[id(c)] for c in nested)
        holds[id(element)] = element.tag in ("article", "main") or any(holds[id(c)] for c in nested)
    free = any(e.tag in ("article", "main") and not inside for e, inside in order)
    for element, _ in order:
        if not element.out or element.out in FIXED or free:
            continue
        if holds[id(element)] if holds[id(root)] else plain[id(element)] > 0.5 * plain[id(root)]:
            element.out = ""


class Tree(HTMLParser):
    """Builds the tree. ``places`` holds, for each tag, where its open elements stand in ``stack``,
    so that what a tag closes is found without walking over all that is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root", None)
        self.stack = [self.root]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.places.get(tag):
            return
        if tag in CLOSES:
            self._close_any(*CLOSES[tag])
        if tag in ENDS_PARAGRAPH:
            self._close_any({"p"}, {"table", "td", "th", "button", "object"})
            if tag in HEADINGS:
                self._close_any(HEADINGS, {"div", "section", "article", "td"})
                self._spare_header()
        made = Element(tag, self.stack[-1], _marked(tag, attrs))
        self.stack[-1].children.append(made)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.stack))
            if tag not in INLINE:
                self.blocks.append(len(self.stack))
            self.stack.append(made)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        place = self._last(tag)
        # An inline end does not reach out of the block it stands in.
        if place > 0 and (tag not in INLINE or place > self.blocks[-1]):
            self._close(place)

    def handle_data(self, data):
        self.stack[-1].children.append(data)

    def _last(self, tag: str) -> int:
        return (self.places.get(tag) or [0])[-1]

    def _close(self, place: int) -> None:
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()

    def _close_any(self, tags: set[str], until: set[str]) -> None:
        limit = max(map(self._last, until))
        found = []
        for places in filter(None, map(self.places.get, tags)):
            found += places[bisect.bisect_right(places, limit) :][:1]
        if found:
            self._close(min(found))

    def _spare_header(self) -> None:
        """The header of an article that holds a heading is its headline, not the page's header."""
        place = self._last("header")
        if place and self.stack[place].out == "header" and max(self._last("article"), self._last("main")) in range(1, place):
            self.stack[place].out = ""


def _kept(root: Element) -> list[Element]:
    """Elements that are not left out, parents first."""
    order, stack = [], [root]
    while stack:
        element = stack.pop()
        order.append(element)
        stack += [c for c in reversed(element.children) if isinstance(c, Element) and not c.out]
    return order


def weigh(root: Element) -> list[Element]:
    """Densities and density sums of all elements that are not left out."""
    order = _kept(root)
    for element in reversed(order):
        for child in element.children:
            if isinstance(child, str):
                n = len("".join(child.split()))
                element.chars += n
            elif not child.out:
                element.chars += child.chars
                element.tags += child.tags + 1
                element.link_chars += child.chars if child.tag == "a" else child.link_chars
                element.link_tags += child.link_tags + (child.tag == "a")
    body = next((e for e in order if e.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for element in order:
        c, t = element.chars, max(element.tags, 1)
        lc, lt = max(element.link_chars, 1), max(element.link_tags, 1)
        if c:
            base = math.log(c / max(c - element.link_chars, 1) * element.link_chars + share * c + math.e)
            # Below one character for each link's share, the logarithm turns negative: no text.
            ratio = c / lc * t / lt
            element.density = max(0.0, c / t * math.log(max(ratio, 1.0)) / math.log(max(base, 1 + 1e-9)) if base > 1 else c / t * math.log(max(ratio, 1.0) + 1))
    for element in order:
        element.total = sum(c.density for c in element.children if isinstance(c, Element) and not c.out)
    return order


def main_subtree(order: list[Element]) -> tuple[Element | None, float, list[Element]]:
    """The element to read, the threshold on the way from the densest sum to the body, and the
    elements to read only in parts: those around the densest sum."""
    body = next((e for e in order if e.tag == "body"), order[0])
    inside = [e for e in _kept(body) if e.chars]
    if not inside:
        return None, 0.0, []
    best = max(inside, key=lambda e: (e.total, e.chars))
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(e.density for e in path)
    for element in reversed(path):
        if element.tag == "article":
            return element, threshold, []
    mains = [k for k, e in enumerate(path) if e.tag == "main"]
    path = path[: mains[-1] + 1] if mains else path
    around = path[1:]
    if best is path[-1]:
        # Paragraphs that stand in the body itself leave no box for the article.
        blocks = [c for c in best.children if isinstance(c, Element) and not c.out and c.tag in CONTAINERS]
        if sum(c.chars for c in blocks) < 0.5 * best.chars:
            around = [best]
    return path[-1], threshold, around


def main_text(html: str | None) -> str:
    """The main text of one page: blocks in order, joined by a space."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(_CUT_TAG.sub("", html))
    tree.close()
    _spare_wrappers(tree.root)
    order = weigh(tree.root)
    top, threshold, around = main_subtree(order)
    if top is None:
        return ""
    # Beside the densest sum, boxes thinner than the threshold are no part of the article.
    path = {id(e) for e in around}
    thin = {
        id(c)
        for e in around
        for c in e.children
        if isinstance(c, Element) and c.tag in CONTAINERS and c.density < threshold and id(c) not in path
    }
    parts: list[str] = []
    stack: list[Element | str] = [top]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
            continue
        linked = top.tag != "article" and node.chars and node.link_chars > 0.5 * node.chars and node.density < threshold
        if node.out or id(node) in thin or (linked and node is not top and node.tag not in INLINE and node.link_tags > 1):
            continue
        spaced = node.tag not in INLINE
        if spaced:
            parts.append("\n")
            stack.append("\n")
        stack += reversed(node.children)
    return " ".join("".join(parts).split())


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, read whole."""

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(batch.schema.get_field_index("html"))]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url")),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
