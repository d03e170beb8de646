"""Web pages as a row of leaf blocks: text between block-level tags, with the elements it stands in."""

from __future__ import annotations

import collections
import html
import re
from dataclasses import dataclass

# Element lists of the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr "
                   # Formulas and embedded objects are text of the line they stand in; their content is kept.
                   "object param source track math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom "
                   "mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd mlabeledtr "
                   "maction semantics annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Without a closing tag, these run to the end of the page.
RAW = frozenset("script style title textarea iframe".split())
SILENT = RAW | frozenset("noscript template svg canvas audio video select".split())
#: Start tags that end an open element: each of these by itself, any block by p.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = frozenset({"table", "ul", "ol", "dl", "body", "html"})
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[=>]")
_BARE = re.compile(r"[^\s>]*")
_BLANK = re.compile(r"\s*")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    """An open element."""

    tag: str
    words: frozenset[str]  #: of its class, id and role
    above: str  #: the tag of the element around it
    around: frozenset[str]  #: features of the tags and words from the page down to it; shared where an element adds none


@dataclass(slots=True)
class Block:
    text: str
    tag: str  #: the innermost block element
    place: Node | None  #: the element it stands in
    linked: int  #: characters within links


@dataclass(slots=True)
class Tag:
    start: int
    end: int
    name: str
    closing: bool
    attributes: str


def _words(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    return frozenset(w.lower() for m in _NAMES.finditer(attributes) for w in _PARTS.findall(m[1] or m[2] or m[3] or ""))


class _Scanner:
    """Finds tags in one pass. A quote opens a value after an equals sign only. A tag that never ends, or whose value doesn't,
    ends at its first ``>``, and without one with the page; comments end with the page at the latest."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.ragged = False  # some tag has no end: from there on, all end at their first >

    def next(self, at: int) -> tuple[int, int, Tag | None] | None:
        """Start, end and, but for comments and the like, the tag."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            m = _NAME.match(page, i)
            if m is not None:
                end = self._end(m.end(), i)
                tag = Tag(i, end, m[1].lower(), page[i + 1] == "/", page[m.end(): end])
                return i, end, tag
            if page.startswith("<!--", i):
                end = page.find("-->", i + 2)
                return i, len(page) if end < 0 else end + 3, None
            if page[i + 1: i + 2] in ("!", "?", "/") and i + 2 < len(page):
                end = page.find(">", i)
                return i, len(page) if end < 0 else end + 1, None
            at = i + 1
        return None

    def _end(self, at: int, start: int) -> int:
        page, last = self.page, self.last
        while not self.ragged and at <= last[">"]:
            stop = _STOP.search(page, at)
            if page[stop.start()] == ">":
                return stop.end()
            at = _BLANK.match(page, stop.end()).end()
            quote = page[at: at + 1]
            if quote and quote in "\"'":
                if at + 1 > last[quote]:
                    break
                at = page.find(quote, at + 1) + 1
            else:
                at = _BARE.match(page, at).end()
        first = page.find(">", start) + 1
        self.ragged = self.ragged or (first > 0 and at > last[">"])
        return first or len(page)


def _tags(page: str) -> tuple[list[tuple[int, int, Tag | None]], dict[int, int]]:
    """All markup outside raw text, and where silent elements begin and end. A silent element that is not closed before an
    element around it (RAW apart) is left out, so that the text after its tag is not lost."""
    scanner, found, out = _Scanner(page), [], {}
    open_: list[tuple[str, int]] = []
    depth: collections.Counter = collections.Counter()
    at = 0
    while (markup := scanner.next(at)) is not None:
        start, at, tag = markup
        found.append(markup)
        if tag is None or tag.name in INLINE or tag.name in VOID:
            continue
        name = tag.name
        if tag.closing:
            while depth[name]:
                other, since = open_.pop()
                depth[other] -= 1
                if other == name:
                    if name in SILENT:
                        out[since] = at
                    break
        elif name in SILENT and tag.attributes.endswith("/>"):
            continue
        elif name in RAW and not depth["svg"]:
            end = _ENDS[name].search(page, at)
            out[start] = at = end.end() if end else len(page)
        else:
            open_.append((name, start))
            depth[name] += 1
    return found, out


class _Open:
    """The elements that are open, and where each tag stands among them."""

    def __init__(self, known):
        self.known, self.stack, self.at = known, [], collections.defaultdict(list)

    def push(self, tag: str, words: frozenset[str]) -> None:
        above = self.stack[-1] if self.stack else None
        adds = {f"in:{tag}", *(f"named:{w}" for w in words)}
        if self.known is not None:
            adds = {f for f in adds if f in self.known}
        around = above.around if above else frozenset()
        self.at[tag].append(len(self.stack))
        self.stack.append(Node(tag, words, above.tag if above else "-", around if adds <= around else around | adds))

    def cut(self, size: int) -> None:
        while len(self.stack) > size:
            self.at[self.stack.pop().tag].pop()

    def last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def leave(self, tags) -> None:
        """Close the innermost element of these tags, unless a scope stands within it."""
        k = self.last(tags)
        if k > self.last(SCOPES):
            self.cut(k)


def blocks(page: str, known=None) -> list[Block]:
    """All leaf blocks with text, in page order. White space is one space; character references are decoded; what ends
    with the page counts as closed there. Silent elements are passed over and end no block. ``known`` has the features that
    are of interest, all if not given."""
    markup, silent = _tags(page)
    out: list[Block] = []
    open_ = _Open(known)
    parts: list[str] = []
    links, linked, at = 0, 0, 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            place = open_.stack[-1] if open_.stack else None
            out.append(Block(text, place.tag if place else "body", place, linked))
        parts.clear()
        linked = 0

    for start, end, tag in markup:
        if start < at:
            continue  # within a silent element
        add(page[at:start])
        at = end
        if tag is None:
            continue
        name = tag.name
        if name in SILENT:
            if not tag.closing:
                at = silent.get(start, at)
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if tag.closing else 1
            elif name == "br":
                parts.append(" ")
            continue
        close()
        links = 0
        if tag.closing:
            if open_.at.get(name):
                open_.cut(open_.at[name][-1])
        elif name not in VOID:
            if open_.stack and open_.stack[-1].tag == "p":
                open_.cut(len(open_.stack) - 1)
            if name in CLOSES:
                open_.leave(CLOSES[name])
            open_.push(name, _words(tag.attributes))
    add(page[at:])
    close()
    return out
