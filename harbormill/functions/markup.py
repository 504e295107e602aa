"""A page of HTML as elements and texts, from one scan.

The scan knows comments, declarations, scripts and styles, and attributes whose quoted values hold '>'. A stack of open
elements gives every element its extent; end tags that are missing are implied where the standard says so (cells, rows, items,
paragraphs, anchors), and stray ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

# every alternative behind one '<', which lets the search skip texts
TOKEN = re.compile(
    r"""<(?:(/?)((?!(?i:script|style)\b)[A-Za-z][^\s/>]*+)((?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>
    |!--.*?(?:-->|\Z)
    |((?i:script|style))\b(?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>.*?(?:</(?i:\4)\s*>|\Z)
    |[!?/][^<>]*+>)""",
    re.X | re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=>"'/][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

# Fixed values of the standard: elements without content, and what a start tag closes up to the nearest of its barriers.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {
    "a": ({"a"}, {"table", "td", "th"}),
    "p": ({"p"}, {"table", "td", "th", "div", "button"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NESTED = {"td": {"table"}, "th": {"table"}, "tr": {"table"}, "li": {"ul", "ol", "menu"}}


class Page:
    """Elements are numbered in the order of their start tags; those inside element i are i + 1 up to ``last[i]``, exclusive."""

    def __init__(self, html: str | None):
        html = html or ""
        self.names: list[str] = []
        self.last: list[int] = []
        self._attrs: list[str] = []
        self._texts: list[str] = []
        self._from: list[int] = []
        self._to: list[int] = []
        names, last, attrs, texts, first, to = self.names, self.last, self._attrs, self._texts, self._from, self._to
        open_: list[int] = []
        at = 0
        for m in TOKEN.finditer(html):
            start = m.start()
            if start > at:
                texts.append(html[at:start])
            at = m.end()
            close, name, attributes, _ = m.groups()
            if name is None:
                continue
            name = name.lower()
            if close:
                if open_ and names[open_[-1]] == name:
                    i = open_.pop()
                    last[i], to[i] = len(names), len(texts)
                else:
                    self._end(open_, {name}, NESTED.get(name, ()))
                continue
            if name in CLOSES and open_:
                self._end(open_, *CLOSES[name], outermost=True)
            names.append(name)
            attrs.append(attributes)
            first.append(len(texts))
            to.append(len(texts))
            last.append(len(names))
            if name not in VOID:
                open_.append(len(names) - 1)
        if at < len(html):
            texts.append(html[at:])
        self._close(open_, 0)

    def _end(self, open_: list[int], names: set[str], barriers, outermost: bool = False) -> None:
        """Close the innermost open element so named, or the outermost one below a barrier, and all inside it."""
        found = None
        for depth in range(len(open_) - 1, -1, -1):
            name = self.names[open_[depth]]
            if name in names:
                found = depth
                if not outermost:
                    break
            elif name in barriers:
                break
        if found is not None:
            self._close(open_, found)

    def _close(self, open_: list[int], depth: int) -> None:
        for i in open_[depth:]:
            self.last[i], self._to[i] = len(self.names), len(self._texts)
        del open_[depth:]

    def attribute(self, i: int, name: str) -> str | None:
        """Of several of that name the first counts; one without a value is empty."""
        for key, *values in ATTRIBUTE.findall(self._attrs[i]):
            if key.lower() == name:
                return plain("".join(values))
        return None

    def is_a(self, i: int, tag: str, classes: frozenset[str] = frozenset()) -> bool:
        if self.names[i] != tag:
            return False
        raw = self._attrs[i]
        # most elements are told by the letters of the classes alone; entities in a class are decoded where they stand
        return not classes or ("&" in raw or all(c in raw for c in classes)) and classes <= set((self.attribute(i, "class") or "").split())

    def inside(self, i: int | None = None) -> range:
        return range(len(self.names)) if i is None else range(i + 1, self.last[i])

    def select(self, path: str, i: int | None = None) -> Iterator[int]:
        """Elements below i that match a path such as ``div.price-wrap div.price``, each step inside the one before."""
        tag, *classes = path.split(" ", 1)[0].split(".")
        rest = path.partition(" ")[2]
        wanted, seen, names = frozenset(classes), -1, self.names
        for j in self.inside(i):
            if names[j] == tag and self.is_a(j, tag, wanted):
                if not rest:
                    yield j
                elif j >= seen:  # what lies in a match that was searched already was found there
                    yield from self.select(rest, j)
                    seen = self.last[j]

    def strings(self, i: int | None = None) -> list[str]:
        """The texts of an element as they stand, entities decoded."""
        lo, hi = (0, len(self._texts)) if i is None else (self._from[i], self._to[i])
        return [plain(t) for t in self._texts[lo:hi]]

    def text(self, i: int) -> str:
        """All text of an element without its tags, blanks trimmed."""
        raw = self._texts[self._from[i] : self._to[i]]
        return plain(raw[0] if len(raw) == 1 else "".join(raw)).strip()

    def own(self, i: int, names: set[str], within: str = "table") -> list[int]:
        """Elements so named inside i, but not inside another ``within`` below it."""
        found, skip = [], -1
        for j in self.inside(i):
            if j < skip:
                continue
            if self.names[j] == within:
                skip = self.last[j]
            elif self.names[j] in names:
                found.append(j)
        return found


def plain(text: str) -> str:
    """Entities decoded; a no-break space is a blank."""
    return unescape(text).replace("\xa0", " ") if "&" in text else text
