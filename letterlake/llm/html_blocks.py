"""Web pages as leaf blocks: runs of text between block boundaries, with their ancestors.

Pages are read by one index that only moves forward, so broken markup of any kind takes time linear in the
page. A tag that never ends is text; a quote that never closes is a character like any other.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

_OPENS = re.compile(r"<(?:!|\?|/?[A-Za-z])")
# Where a tag may end, or a quoted value begins that may hold such a character.
_STOP = re.compile(r">|=\s*+([\"'])")
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
# One attribute with its value, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# The mark of an element that is not shown; no class word has brackets.
HIDDEN = "[hidden]"
# Before a word of a name of several words.
PART = "-"
_SPACE = re.compile(r"\s+")

# Blocks know so many of their nearest ancestors.
NEAREST = 64

# Tags whose content is no text of the page, tags without content, tags that begin and end a
# block. Any other tag stands inside a line of text, as those of formulas do; one with a hyphen is a box.
RAW = frozenset("script style noscript template textarea iframe audio video title".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOXES = frozenset(
    "html head body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
# These end a block, too, though nothing is in them.
_BREAKS = VOID - frozenset("br img wbr".split())
# A new one of these ends an open one of the same set.
_SIBLINGS = [frozenset(("li",)), frozenset(("dt", "dd")), frozenset(("tr",)), frozenset(("td", "th")), frozenset(("option",))]
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)


@dataclass
class Block:
    text: str
    path: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    linked: int = 0
    shown: bool = True


def _marks(tag: str) -> tuple[str, ...]:
    found = []
    for match in _ATTRIBUTE.finditer(tag, _NAME.match(tag).end()):
        value = next((g for g in match.groups()[1:] if g is not None), "")
        name = match.group(1).lower()
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            found.append(HIDDEN)
        elif name in ("class", "id", "role"):
            for whole in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
                words = [w for w in re.split(r"[^a-z]+", whole) if w]
                # A name of several words is itself, and of its words less than each alone would be.
                found += words if len(words) == 1 else ["-".join(words), *(f"{PART}{w}" for w in words)]
    return tuple(found)


class _Path:
    """The open elements, with the places of each tag among them, so that closing looks none of them over."""

    def __init__(self) -> None:
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self._places: dict[str, list[int]] = defaultdict(list)
        self._unseen = 0

    @property
    def shown(self) -> bool:
        return not self._unseen and not self._places["head"]

    def push(self, name: str, marks: tuple[str, ...]) -> None:
        self._places[name].append(len(self.open))
        self.open.append((name, marks))
        self._unseen += HIDDEN in marks

    def close(self, names: frozenset[str], until: frozenset[str] = frozenset()) -> None:
        """Closes the innermost of ``names`` and what is in it, unless one of ``until`` is further in."""
        innermost = lambda tags: max((self._places[tag][-1] for tag in tags if self._places[tag]), default=-1)
        at = innermost(names)
        if at < 0 or at < innermost(until):
            return
        while len(self.open) > at:
            name, marks = self.open.pop()
            self._places[name].pop()
            self._unseen -= HIDDEN in marks


class _Tags:
    """Finds the tags of a page from left to right."""

    def __init__(self, page: str) -> None:
        self.page = page
        self._unclosed: set[str] = set()
        self._plain = self._over = False

    def _end(self, at: int) -> int:
        """Behind the > that ends the tag, or -1."""
        page, place = self.page, at
        while not self._plain:
            stop = _STOP.search(page, place)
            if not stop:
                # From here to the end of the page quotes hide every >, so they are none.
                self._plain = True
                break
            if not stop.group(1):
                return stop.end()
            place = stop.end()
            if stop.group(1) not in self._unclosed:
                closed = page.find(stop.group(1), place)
                if closed < 0:
                    self._unclosed.add(stop.group(1))
                else:
                    place = closed + 1
        return page.find(">", at) + 1 or -1

    def next(self, place: int) -> tuple[int, int] | None:
        """Start and end of the next tag, comment or declaration from ``place`` on."""
        page = self.page
        while opened := _OPENS.search(page, place):
            at = opened.start()
            for begin, end in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if page.startswith(begin, at):
                    closed = page.find(end, at + len(begin))
                    return at, closed + len(end) if closed >= 0 else len(page)
            if page[at + 1] in "!?":
                return at, page.find(">", at) + 1 or len(page)
            end = -1 if self._over else self._end(at + 1)
            if end >= 0:
                return at, end
            self._over = True
            place = at + 1
        return None


def blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order, character references decoded, white space as single spaces."""
    out: list[Block] = []
    path, tags = _Path(), _Tags(page)
    parts: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(Block(text, path.open[-NEAREST:], min(linked, len(text)), path.shown))
        parts.clear()
        linked = 0

    while found := tags.next(at):
        start, end = found
        if start > at:
            piece = page[at:start]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        at = end
        tag = page[start:end]
        name_match = _NAME.match(tag)
        if not name_match:
            if tag.startswith("<![CDATA["):
                parts.append(tag[9:].removesuffix("]]>"))
            continue
        name, closing = name_match.group(1).lower(), tag[1] == "/"
        if name in RAW:
            if not closing and not tag.endswith("/>"):
                # Only the element's own end tag is markup in here.
                ended = _RAW_END[name].search(page, at)
                at = ended.end() if ended else len(page)
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            parts.append(" ")
        if name not in BOXES and name not in _BREAKS and "-" not in name:
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            path.close(frozenset((name,)))
            continue
        links = 0
        if name not in ("html", "head"):
            # A head need not be closed: what is shown ends it.
            path.close(frozenset(("head",)), frozenset(("body",)))
        if name in _ENDS_P:
            path.close(frozenset(("p",)), frozenset(("td", "th", "li", "body", "article", "section", "div")))
        for group in _SIBLINGS:
            if name in group:
                path.close(group, frozenset(("ul", "ol", "dl", "table", "select")))
        path.push(name, _marks(tag))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out
