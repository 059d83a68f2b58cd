"""Read elements of one HTML page by tag, class and position.

A small helper for the extraction tasks. Elements and text runs share one
running number, so everything inside an element is a range of numbers.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cached_property
from html import unescape

# Elements without content.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}

_TOKEN = re.compile(
    r"""<!--(.*?)(?:-->|\Z)|<[!?][^>]*>"""
    r"""|<(script|style)\b[^>]*>(.*?)(?:</\2\s*>|\Z)"""
    r"""|<(/?)([a-z][^\s/>]*)((?:[^>=]++|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_REFERENCE = re.compile(r"&[#A-Za-z0-9]+(?:;|(?![=A-Za-z0-9;]))")
_NONE: tuple = ((), ())


@dataclass(frozen=True)
class Step:
    """One descent into the page: the n-th matching element below, or around, the present one."""

    tag: str
    cls: str | None = None  # the whole class text, or one class of it
    part: str | None = None  # a part of some class
    id: str | None = None
    at: int = 0
    around: bool = False

    @cached_property
    def plain(self) -> bool:
        return self.cls is None and self.part is None and self.id is None

    @cached_property
    def _sign(self) -> str | None:
        """What the source of every fitting element holds."""
        wanted = self.cls or self.part or self.id
        return None if wanted is None else wanted.split()[0]

    def fits(self, element: Element) -> bool:
        sign = self._sign
        if sign is None:
            return True
        if sign not in element.source:
            return False
        if self.id is not None and element.attrs.get("id") != self.id:
            return False
        if self.cls is None and self.part is None:
            return True
        classes = element.attrs.get("class", "").split()
        if self.cls is not None:
            return self.cls in classes or self.cls == " ".join(classes)
        return self.part in " ".join(classes)


class Element:
    __slots__ = ("tag", "source", "start", "end", "parent", "_attrs")

    def __init__(self, tag: str, source: str, start: int, parent: Element | None):
        self.tag, self.source, self.start, self.end, self.parent = tag, source, start, start, parent
        self._attrs = None

    @property
    def attrs(self) -> dict[str, str]:
        """Parsed on first use: most elements are never asked."""
        if self._attrs is None:
            self._attrs = attrs = {}
            if self.source:
                for name, double, single, bare in _ATTRIBUTE.findall(self.source):
                    value = double or single or bare
                    if "&" in value:
                        value = _REFERENCE.sub(lambda m: unescape(m.group()), value)
                    attrs.setdefault(name.lower(), value)
        return self._attrs


class Page:
    def __init__(self, html: str):
        self.root = Element("", "", 0, None)
        self.hidden: list[str] = []  # comments, scripts, styles
        # by tag the elements and, beside them, where they start; "*" is every element
        self._by_tag: dict[str, tuple[list[Element], list[int]]] = {"*": ([], [])}
        self._texts: list[str] = []
        self._text_at: list[int] = []
        self._read(html)

    def _read(self, html: str) -> None:
        texts, text_at, by_tag = self._texts, self._text_at, self._by_tag
        everything, all_starts = by_tag["*"]
        add_text, add_text_at, add_element, add_start = texts.append, text_at.append, everything.append, all_starts.append
        parent, clock = self.root, 0
        open_elements = [parent]
        still_open: dict[str, int] = {}  # by tag: an end tag without a beginning looks at no open element
        parts = _TOKEN.split(html)  # a text, then the six groups of the token behind it; at the end a text alone
        for text, comment, _, hidden, close, tag, source in zip(*[iter(parts)] * 7):
            if text:
                clock += 1
                add_text(text)
                add_text_at(clock)
            if tag is None:
                if comment or hidden:
                    self.hidden.append(comment or hidden)
                continue
            tag = tag.lower()
            if close:
                while still_open.get(tag):
                    element = open_elements.pop()
                    element.end = clock
                    still_open[element.tag] -= 1
                    if element.tag == tag:
                        break
                parent = open_elements[-1]
                continue
            clock += 1
            element = Element(tag, source, clock, parent)
            add_element(element)
            add_start(clock)
            if tag in by_tag:
                same, starts = by_tag[tag]
                same.append(element)
                starts.append(clock)
            else:
                by_tag[tag] = ([element], [clock])
            if tag not in _VOID and not (source and source[-1] == "/"):
                open_elements.append(element)
                parent = element
                still_open[tag] = still_open.get(tag, 0) + 1
        if parts[-1]:
            clock += 1
            texts.append(parts[-1])
            text_at.append(clock)
        for element in open_elements:
            element.end = clock

    def select(self, step: Step, inside: Element | None = None) -> list[Element]:
        inside = inside or self.root
        if step.around:
            found, element = [], inside.parent
            while element is not None:
                if element.tag == step.tag and step.fits(element):
                    found.append(element)
                element = element.parent
            return found
        elements, starts = self._by_tag.get(step.tag, _NONE)
        first = bisect_left(starts, inside.start + 1)
        last = bisect_left(starts, inside.end + 1, first)
        return [e for e in elements[first:last] if step.fits(e)]

    def follow(self, steps: tuple[Step, ...], inside: Element | None = None) -> Element | None:
        inside = inside or self.root
        for step in steps:
            inside = self.nth(step, inside)
            if inside is None:
                return None
        return inside

    def nth(self, step: Step, inside: Element) -> Element | None:
        if step.around:
            found = self.select(step, inside)
            return found[step.at] if len(found) > step.at else None
        elements, starts = self._by_tag.get(step.tag, _NONE)
        at = bisect_left(starts, inside.start + 1)
        if step.plain:
            at += step.at
            return elements[at] if at < len(starts) and starts[at] <= inside.end else None
        left = step.at
        while at < len(starts) and starts[at] <= inside.end:
            element = elements[at]
            if step.fits(element):
                if left == 0:
                    return element
                left -= 1
            at += 1
        return None

    def runs(self, element: Element) -> list[str]:
        at = self._text_at
        first = bisect_left(at, element.start)
        found = self._texts[first : bisect_left(at, element.end + 1, first)]
        return [unescape(t) if "&" in t else t for t in found]

    def text(self, element: Element) -> str:
        return "".join(self.runs(element)).strip()

    def joined(self, element: Element, separator: str) -> str:
        return separator.join([t for run in self.runs(element) if (t := run.strip())])

    def every_text(self) -> list[str]:
        return self._texts + self.hidden
