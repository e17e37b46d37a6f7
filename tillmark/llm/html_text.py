"""Main text of HTML pages by tree scoring.

Each block of text passes points to its ancestors: one, one per comma and one per hundred
characters (three at most), to the parent in full, to the grandparent half, to those above ever
less. Points are discounted by the share of an element's text that lies in links. An outermost
`article`, or `main` outside of one, has its text's points in full, and its rank counts half as much
again. The best container decides: if it lies in an `article`, or else in a `main`, that is it. It
is lifted to an ancestor that holds half as much again in points outside of links, whatever lies in
between, and kept together with those siblings that score well or read like prose. Within the
container everything stays but what by tag, role or name is a menu, header, footer, sidebar, notice,
advert, form or comment, and lists of links in a container that was lifted to.

Tags and roles drop an element with all it holds. A class or id does so only if one of its names is
that of such a part (`site-header` and `sidebar-left`, but neither `has-sidebar` nor `header-fixed`),
and never if the element holds an article or main, or more than half of the page's text outside links
(nearly all of it, if it is named for comments, which are often longer than their article): then it
stays, and what lies in it counts a tenth.
A form is one by its fields: with none, or with much text to each, it is a wrapper like others.

White space within a block is one space; blocks follow in page order, joined by one space.

The parser takes any input: unclosed, misnested and unknown tags, and documents that break off. It
is linear in the page: elements nested deeper than `DEEPEST`, as in browsers, become siblings.

Defined cases: a null page is an empty one and has an empty text; so has a page without blocks. Very
long pages are read whole. Repeated rows give repeated rows, an empty table none. Other columns stay as
they are, but one of the text's name is replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.batches import bounded, extended, pieces, strings

# ---- fixed values: what tags mean ------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head nav header footer aside button select option menu dialog fieldset input object"
    " audio video canvas map".split()
) | RAW
FIELDS = frozenset("input select textarea button".split())
KEPT_CONTAINERS = frozenset(("article", "main", "body", "html"))
# An open element that a new one of these closes.
CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
# A paragraph ends before these.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main"
    " nav ol p pre section table ul".split()
)
BOUNDS = frozenset("article main section div td th table ul ol body html aside nav".split())
PARAGRAPHS = frozenset("p pre blockquote li h1 h2 h3 h4 h5 h6 dd".split())
PROSE = frozenset("p h1 h2 h3 blockquote pre".split())
SEMANTIC = frozenset(("article", "main"))
UNWANTED_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar dialog alert alertdialog"
    " form toolbar".split()
)
# Names that say what a part of a page is, and words that may follow one in a class or id.
UNWANTED_WORDS = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising banner sponsor sponsored promo"
    " promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer"
    " bottombar sidebar aside rail widget widgets comment comments disqus respond reply replies"
    " discussion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social related recommended recommendations"
    " pagination pager form search toolbar skip tags".split()
)
COMMENT_WORDS = frozenset("comment comments disqus respond reply replies discussion".split())
PART_WORDS = frozenset(
    "area bar body bottom box button buttons column container content field footer header icons inner"
    " item items left link links list main outer panel right section slot text thread title top unit"
    " wrap wrapper".split()
)
# A name that begins so tells of a page's state: it holds no such part, or more than one.
STATES = frozenset("has have with without no not is hide hides show shows".split())

MOST, NEARLY_ALL = 0.5, 0.95  # of a page's text outside links

# ---- parser ----------------------------------------------------------------------------------

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?i)(?<![\w-])(class|id|role|hidden|aria-hidden|style)\s*"
                        r"(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_LETTERS = re.compile(r"[a-z]+")
_NO_FIELD = re.compile(r"(?i)(?<![\w-])type\s*=\s*[\"']?hidden")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


DEEPEST = 512  # the limit that browsers have


class Element:
    __slots__ = (
        "tag", "parent", "children", "unwanted", "named", "field", "weight", "score", "whole", "chars",
        "linked",
    )

    def __init__(self, tag: str, parent: Element | None, rest: str = ""):
        self.tag, self.parent = tag, parent
        self.unwanted = _unwanted(tag, rest)
        self.named = 0.0 if self.unwanted else _named(tag, rest)
        self.field = tag in FIELDS and not _NO_FIELD.search(rest)
        self.children: list[Element | str] = []
        self.weight, self.score, self.whole, self.chars, self.linked = 1.0, 0.0, 0.0, 0, 0


def _words(name: str) -> list[str]:
    # A capital starts a word: siteNav is site and nav.
    return _LETTERS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())


def _unwanted(tag: str, rest: str) -> bool:
    """Whether tag, role or style drop an element with all it holds."""
    if tag in DROPPED:
        return True
    if not rest or tag in KEPT_CONTAINERS:
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and _HIDDEN.search(value):
            return True
        if name == "role" and value.strip().lower() in UNWANTED_ROLES:
            return True
    return False


def _named(tag: str, rest: str) -> float:
    """The share of a page's text that an element must hold to stay although a class or id says that
    it is an unwanted part; 0 if none does."""
    if not rest or tag in KEPT_CONTAINERS and "comment" not in rest.lower():
        return 0.0
    parts = [
        words
        for name, *values in _ATTRIBUTE.findall(rest) if name.lower() in ("class", "id")
        for token in "".join(values).split() if _part(words := _words(token))
    ]
    if not parts:
        return 0.0
    return MOST if all(COMMENT_WORDS.isdisjoint(words) for words in parts) else NEARLY_ALL


def _part(words: list[str]) -> bool:
    if not words or words[0] in STATES:
        return False
    if words[-1] in UNWANTED_WORDS:
        return True
    first = next((i for i, w in enumerate(words) if w in UNWANTED_WORDS), None)
    return first is not None and all(
        w in PART_WORDS or w in UNWANTED_WORDS or len(w) == 1 for w in words[first:]
    )


def parse(page: str) -> Element:
    root = Element("html", None)
    now, depth_of = root, {"html": 1}  # open elements by tag
    at = depth = 0

    def close(tag: str) -> None:
        nonlocal now, depth
        last = None
        while last != tag:
            last = now.tag
            depth_of[last] -= 1
            depth -= 1
            now = now.parent

    while at < len(page):
        m = _MARKUP.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            now.children.append(text)
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["close"] or m["close2"]:
            if tag == "br":
                now.children.append(Element("br", now))
            elif tag != "html" and depth_of.get(tag) and _within_reach(now, tag):
                close(tag)
            continue
        if tag in ("html",):
            continue
        for other in CLOSES.get(tag, ()):
            if depth_of.get(other) and _within_reach(now, other):
                close(other)
        if tag in ENDS_PARAGRAPH and depth_of.get("p") and _within_reach(now, "p"):
            close("p")
        element = Element(tag, now, m["rest"] or "")
        now.children.append(element)
        if tag in RAW:  # no markup inside
            end = _end_of(page, tag, at)
            at = end
        elif depth < DEEPEST and tag not in VOID and not (m["rest"] or "").endswith("/"):
            now = element
            depth += 1
            depth_of[tag] = depth_of.get(tag, 0) + 1
    return root


def _within_reach(now: Element, tag: str) -> bool:
    """Whether the innermost element of that tag may be closed from here: an end tag of inline or
    paragraph kind doesn't reach out of its container. Only inline elements lie in between, or the
    tag is itself a container."""
    if tag in BOUNDS:
        return True
    while now.tag != tag:
        if now.tag in BOUNDS:
            return False
        now = now.parent
        if now is None:
            return False
    return True


def _end_of(page: str, tag: str, at: int) -> int:
    m = re.compile(rf"(?i)</{tag}\b[^>]*(?:>|\Z)").search(page, at)
    return m.end() if m else len(page)


# ---- parts by name ---------------------------------------------------------------------------

PER_FIELD, WHATEVER_ELSE = 200, 1000  # characters to a field that make a form a wrapper
NAMED_WEIGHT = 0.1


def judge(root: Element) -> None:
    """Drops the elements that by name, or as a form, are unwanted parts. `chars` is for this while
    the text outside of links."""
    order, stack = [], [(root, False)]
    while stack:
        element, in_link = stack.pop()
        in_link = in_link or element.tag == "a"
        order.append(element)
        for child in () if element.unwanted else element.children:
            if isinstance(child, str):
                element.chars += 0 if in_link else len(child.strip())
            elif not child.unwanted or child.field:
                stack.append((child, in_link))
    fields: dict[int, int] = {}
    holds: set[int] = set()  # elements with an article or main inside
    for element in reversed(order):
        above = element.parent
        if above is not None:
            above.chars += element.chars
            n = fields.get(id(element), 0) + element.field
            if n:
                fields[id(above)] = fields.get(id(above), 0) + n
            if id(element) in holds or element.tag in SEMANTIC and not element.named:
                holds.add(id(above))
    for element in order:
        if id(element) not in holds:
            if element.named:
                element.unwanted = element.chars <= element.named * root.chars
                element.weight = NAMED_WEIGHT
            elif element.tag == "form" and (n := fields.get(id(element))):
                most = element.chars > MOST * root.chars
                element.unwanted = element.chars < n * (PER_FIELD if most else WHATEVER_ELSE)
    for element in order:
        element.chars = 0


# ---- blocks and scores -----------------------------------------------------------------------


class Block:
    """Text between two block boundaries, and the innermost block element that holds it."""

    __slots__ = ("holder", "text", "linked", "dropped")

    def __init__(self, holder: Element, text: str, linked: int, dropped: bool):
        self.holder, self.text, self.linked, self.dropped = holder, text, linked, dropped


def blocks(root: Element) -> list[Block]:
    found: list[Block] = []
    parts: list[str] = []
    linked, holder, gone = 0, root, False

    def end() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append(Block(holder, text, min(linked, len(text)), gone))
        parts.clear()
        linked = 0

    # [element, child to visit next, in a link, dropped, innermost block element]
    stack: list[list] = [[root, 0, False, False, root]]
    while stack:
        top = stack[-1]
        element, i, in_link, dropped, inner = top
        if i == len(element.children):
            stack.pop()
            if element.tag not in INLINE or stack and stack[-1][3] != dropped:
                end()
            if stack:
                gone, holder = stack[-1][3:]
            continue
        top[1] = i + 1
        child = element.children[i]
        if isinstance(child, str):
            text = html.unescape(child) if "&" in child else child
            parts.append(text)
            if in_link:
                linked += len(text.strip())
            continue
        out = dropped or child.unwanted
        if child.tag in ("br", "hr"):
            parts.append(" ")
        elif child.tag in RAW:
            continue
        else:
            if child.tag not in INLINE or out != dropped:
                end()
                inner = inner if child.tag in INLINE else child
                holder, gone = inner, out
            stack.append([child, 0, in_link or child.tag == "a", out, inner])
    end()
    return found


def _ancestors(element: Element | None) -> Iterator[Element]:
    while element is not None:
        yield element
        element = element.parent


def _outermost(element: Element, tag: str) -> Element | None:
    found = None
    for ancestor in _ancestors(element):
        if ancestor.tag == tag:
            found = ancestor
    return found


BONUS = 1.5  # by which the rank of an `article` or `main` counts more
MORE = 1.5  # times its points that an ancestor holds in all if the container is to be lifted


def _semantic(element: Element) -> Element | None:
    """The outermost article that an element lies in, else the outermost main."""
    return _outermost(element, "article") or _outermost(element, "main")


def score(found: list[Block]) -> None:
    """Points, text and linked text of all ancestors. An article or main has the points of what it
    is the outermost one of in full, since it stands for all of it. `whole` is the sum in full of
    the points outside of links, whatever lies in between."""
    at: dict[int, list] = {}  # what blocks give to one element: element, points, chars, linked
    for block in found:
        if block.dropped:
            continue
        points = 1 + block.text.count(",") + min(len(block.text) / 100, 3)
        near = block.holder
        # A paragraph, heading or cell is no container itself; its parent is the first to score.
        if near.tag in PARAGRAPHS:
            near = near.parent or near
        sums = at.setdefault(id(near), [near, 0.0, 0, 0, 0.0])
        sums[1] += points
        sums[2] += len(block.text)
        sums[3] += block.linked
        sums[4] += points * (1 - block.linked / len(block.text))
    for near, points, chars, linked, unlinked in at.values():
        semantic = _semantic(near)
        for ancestor in _ancestors(near):
            points, unlinked = points * ancestor.weight, unlinked * ancestor.weight
        for level, ancestor in enumerate(_ancestors(near)):
            ancestor.chars += chars
            ancestor.linked += linked
            ancestor.whole += unlinked
            less = 1 if ancestor is semantic or not level else 2 if level == 1 else 3 * level
            ancestor.score += points / less


def density(element: Element) -> float:
    return element.linked / element.chars if element.chars else 0.0


def _rank(element: Element) -> float:
    return element.score * (1 - density(element))


def _scored(found: list[Block]) -> list[Element]:
    scored, seen = [], set()
    for block in found:
        if not block.dropped:
            for ancestor in _ancestors(block.holder):
                if id(ancestor) in seen:
                    break
                seen.add(id(ancestor))
                if ancestor.score:
                    scored.append(ancestor)
    return scored


def _page(element: Element) -> bool:
    return element.parent is None or element.tag == "body"


def _elements(element: Element) -> list[Element]:
    return [c for c in element.children if not isinstance(c, str) and not c.unwanted]


def _lifted(best: Element) -> Element:
    """The container, lifted while an ancestor holds half as much again in all: text in wrappers of
    its own leaves no points to the container that they share. Leaving an article or main takes
    more. If most of what was reached lies in one container, it is that one."""
    main, above = best, best.parent
    while above is not None:
        more = 1 + BONUS if main.tag in SEMANTIC else MORE
        if above.whole >= more * main.whole > 0:
            main = above = _semantic(above) or above
        above = above.parent
    while main is not best and main.tag not in SEMANTIC:
        inner = max(_elements(main), key=lambda e: e.whole, default=main)
        if inner.whole * MORE <= main.whole or inner is main or inner.tag in PARAGRAPHS:
            break
        main = inner
    return main


def _wrapped(element: Element) -> Element:
    """The outermost element that holds nothing else."""
    while not _page(element) and element.parent.chars == element.chars:
        element = element.parent
    return element


def _inner(element: Element) -> Element:
    """The innermost element, down to a paragraph, that holds all there is."""
    while element.tag not in PARAGRAPHS:
        inner = _elements(element)
        if len(inner) != 1 or any(isinstance(c, str) and c.strip() for c in element.children):
            break
        element = inner[0]
    return element


def _peak(element: Element) -> float:
    """The best rank within."""
    best, stack = 0.0, [element]
    while stack:
        now = stack.pop()
        best = max(best, _rank(now))
        stack.extend(c for c in _elements(now) if c.score)
    return best


def _alike(beside: list[Element], main: Element, least: float) -> list[Element]:
    """Those that score well or read like prose, wrapped if the container is a wrapped paragraph.
    An article or main beside another container is a text of its own."""
    wrapped = _inner(main).tag in PROSE
    return [
        e for e in beside
        if e is main or density(e) < 0.5 and (e.tag not in SEMANTIC or main.tag in SEMANTIC) and (
            e.tag in PROSE or wrapped and _inner(e).tag in PROSE or _peak(e) >= least
        )
    ]


def main_containers(found: list[Block]) -> tuple[list[Element], list[Element]]:
    """The best container and those of its siblings that belong to it; children of it that don't."""
    score(found)
    scored = _scored(found)
    if not scored:
        return [], []
    outermost = {id(s) for e in scored if (s := _semantic(e))}
    best = max(scored, key=lambda e: _rank(e) * (BONUS if id(e) in outermost else 1))
    best = _semantic(best) or best
    main = _lifted(best)
    if main.tag in SEMANTIC:
        return [main], []
    if main is best:
        main = _wrapped(best)
        if _page(main):
            return [main], []
        return _alike(_elements(main.parent), main, max(2.0, 0.2 * _rank(best))), []
    inner = _elements(main)
    lists = [e for e in inner if density(e) >= 0.5]
    if not _page(main):
        return _alike(_elements(main.parent), main, max(2.0, 0.2 * main.whole)), lists
    # Of a whole page, what reaches from the first to the last of the containers alike.
    first = max(inner, key=_peak, default=main)
    alike = {id(e) for e in _alike(inner, first, max(2.0, 0.2 * _peak(first)))}
    places = [i for i, e in enumerate(inner) if id(e) in alike]
    if places:
        between = range(places[0], places[-1] + 1)
        lists = [
            e for i, e in enumerate(inner)
            if id(e) not in alike and (i not in between or density(e) >= 0.5 or e.tag in SEMANTIC)
        ]
    return [main], lists


def main_text(page: str) -> str:
    root = parse(page)
    judge(root)
    found = blocks(root)
    containers, left_out = main_containers(found)
    kept = {id(e) for e in containers}
    if not kept:
        return ""
    inside = {id(e): False for e in left_out}

    def belongs(element: Element) -> bool:
        path = []
        verdict = False
        for a in _ancestors(element):
            if id(a) in inside:
                verdict = inside[id(a)]
                break
            path.append(a)
            if id(a) in kept:
                verdict = True
                break
        for a in path:
            inside[id(a)] = verdict
        return verdict

    return " ".join(b.text for b in found if not b.dropped and belongs(b.holder))


# ---- the operator ----------------------------------------------------------------------------


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, pages in pieces(batch, batch["html"]):
            texts = pa.array([main_text(p) for p in strings(pages)], pa.string())
            yield pa.RecordBatch.from_arrays([rows["row"], texts], names=["row", "text"])


def extract(pages: DataFrame, page: str = "html", name: str = "text") -> DataFrame:
    """All columns but the page itself, and its main text under `name`."""
    bounded(pages.sparkSession)
    others = [c for c in pages.columns if c != page]
    rows = pages.select(
        F.struct(F.lit(0).alias("__row"), *[F.col(f"`{c}`") for c in others]).alias("row"),
        F.col(f"`{page}`").alias("html"),
    )
    found = rows.mapInArrow(_extracted, extended(rows.select("row").schema, "text string"))
    return found.select(
        *[F.col(f"row.`{c}`") for c in others if c != name], F.col("text").alias(name)
    )


def report(pages: DataFrame, page_id: str = "page_id", url: str = "url",
           page: str = "html") -> DataFrame:
    found = extract(pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")
    ))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
