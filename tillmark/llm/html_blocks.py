"""Leaf blocks of a page: its pieces of text with the elements that enclose them."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# Their content is not text of the page.
UNSEEN = frozenset("script style template noscript iframe object svg math textarea select title canvas audio video".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol dl table menu".split())

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"[>\"']")
_HINT = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Open:
    """An open element: its name, what encloses it, and which telling names and hints hold inside it.

    The two sets are those of the element around it wherever this one adds nothing.
    """

    __slots__ = ("name", "around", "inside", "hints")

    def __init__(self, name: str, around: Open | None, inside: frozenset[str], hints: frozenset[str]):
        self.name, self.around, self.inside, self.hints = name, around, inside, hints


@dataclass
class Leaf:
    text: str  # references decoded, white space folded
    linked: int  # characters of it that stand in links
    element: Open | None  # the innermost enclosing element

    @property
    def tag(self) -> str:
        return self.element.name if self.element else ""

    @property
    def inside(self) -> frozenset[str]:
        """Telling names of the enclosing elements."""
        return self.element.inside if self.element else frozenset()

    @property
    def hints(self) -> frozenset[str]:
        """Telling words of their classes, ids and roles."""
        return self.element.hints if self.element else frozenset()

    @property
    def tags(self) -> tuple[str, ...]:
        """All enclosing elements, the outermost first; as many steps as there are."""
        found, at = [], self.element
        while at:
            found.append(at.name)
            at = at.around
        return tuple(reversed(found))


def enclosed(tags: tuple[str, ...], hints: frozenset[str] = frozenset()) -> Open | None:
    """The innermost of elements that enclose each other, with hints that hold inside."""
    element, inside = None, frozenset()
    for name in tags:
        inside |= {name}
        element = Open(name, element, inside, hints)
    return element


class _Ends:
    """Where the tags of a page end: at the first ``>`` that is in no quotes.

    From a mark outside quotes the way to the end is always the same, so it is gone once, however many unclosed tags
    lead to it.
    """

    def __init__(self, page: str):
        self.page = page
        self.marks = [m.start() for m in _MARK.finditer(page)]
        self.ends: dict[int, int] = {}

    def after(self, place: int) -> int:
        """The place of the ``>``, or -1."""
        passed, end = [], -1
        at = bisect_left(self.marks, place)
        while at < len(self.marks):
            if at in self.ends:
                end = self.ends[at]
                break
            passed.append(at)
            mark = self.marks[at]
            if self.page[mark] == ">":
                end = mark
                break
            closing = self.page.find(self.page[mark], mark + 1)
            if closing < 0:
                break
            at = bisect_left(self.marks, closing + 1)
        for at in passed:
            self.ends[at] = end
        return end


def _hints(attributes: str) -> tuple[str, ...]:
    found = []
    for match in _HINT.finditer(attributes):
        value = next(g for g in match.groups() if g is not None)
        found += _PART.findall(_CAMEL.sub(" ", value).lower())
    return tuple(found)


def leaves(page: str | None, names: frozenset[str] | None = None, words: frozenset[str] | None = None) -> list[Leaf]:
    """The blocks of ``page`` in order; none for a null, empty or textless page.

    A block is the text between two starts or ends of elements that are not inline.  Unclosed paragraphs, list items
    and cells end where the HTML standard ends them; a line break counts as white space.  A ``<`` that begins no tag is
    text.  ``names`` and ``words`` say which enclosing elements and hints are telling (none given: all are); with them a
    page takes time in proportion to its length, however broken and deeply nested it is.
    """
    if not page:
        return []
    out: list[Leaf] = []
    stack: list[Open] = []
    where: dict[str, list[int]] = defaultdict(list)  # places of the open elements of a name in the stack
    pieces: list[str] = []
    ends = _Ends(page)
    linked = 0
    place = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Leaf(text, min(linked, len(text)), stack[-1] if stack else None))
            pieces.clear()
        linked = 0

    def last(of: Iterable[str]) -> int:
        return max((where[name][-1] for name in of if where.get(name)), default=-1)

    def drop(depth: int) -> None:
        while len(stack) > depth:
            where[stack.pop().name].pop()

    def start(name: str, attributes: str) -> None:
        around = stack[-1] if stack else None
        inside = around.inside if around else frozenset()
        hints = around.hints if around else frozenset()
        if name not in inside and (names is None or name in names):
            inside = inside | {name}
        own = [h for h in _hints(attributes) if h not in hints and (words is None or h in words)]
        where[name].append(len(stack))
        stack.append(Open(name, around, inside, hints.union(own) if own else hints))

    size = len(page)
    while place < size:
        sign = page.find("<", place)
        if sign < 0:
            sign = size
        if sign > place:
            text = page[place:sign]
            pieces.append(text)
            if where.get("a"):
                linked += len(text.strip())
        if sign == size:
            break
        if page.startswith("<!--", sign):
            stop = page.find("-->", sign + 4)
            place = size if stop < 0 else stop + 3
            continue
        if page[sign + 1 : sign + 2] in ("!", "?"):
            stop = page.find(">", sign)
            place = size if stop < 0 else stop + 1
            continue
        match = _NAME.match(page, sign)
        stop = ends.after(match.end()) if match else -1
        if stop < 0:  # a lone sign
            pieces.append("<")
            place = sign + 1
            continue
        place = stop + 1
        name, attributes = match[1].lower(), page[match.end() : stop]
        if page[sign + 1] == "/":
            if name not in INLINE:
                flush()
            if where.get(name):
                drop(where[name][-1])
            continue
        if name in UNSEEN:
            if name not in INLINE and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, place)
                place = end.end() if end else size
            continue
        if name not in INLINE:
            flush()
            closed = ("p",) if name in CLOSES_PARAGRAPH else CLOSES.get(name, ())
            depth = last(closed)
            if depth >= 0 and (closed == ("p",) or depth > last(SCOPES)):
                drop(depth)
        elif name == "br":
            pieces.append(" ")
        if name not in VOID:
            start(name, attributes)
    flush()
    return out
