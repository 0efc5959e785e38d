"""Pages as elements over a row of text pieces."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape

# Kinds of elements as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - frozenset("body caption head html legend optgroup option tbody td tfoot th thead tr".split())
#: What a start tag ends, up to the element that holds such ones.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
}
#: An end tag finds no element beyond these.
SCOPE = frozenset("caption table td th template".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>"
    r"|</?[A-Za-z][^<>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    #: Values of class and id, and the role.
    names: str
    role: str
    #: Its pieces of text, from the first one on before the last one.
    first: int
    last: int = -1
    #: Hash of its tag, its text and its children.
    digest: bytes = b""


class Page:
    """Elements of a page in the order of their start tags; element 0 is the whole.

    ``pieces`` are its texts with references decoded, and ``breaks`` says before which
    of them a block starts or ends; the last one stands for the end. Texts of scripts,
    styles and the like are left out. Elements are closed as the standard says where
    end tags are missing or misplaced, and all where the page ends early.
    """

    def __init__(self, html: str):
        self.pieces: list[str] = []
        self.breaks: list[bool] = [True]
        self.elements = [Element("", -1, "", "", 0)]
        self._open = [0]
        self._counts: Counter[str] = Counter()
        self._parts: list[list[bytes]] = [[]]
        self._read(html)
        while self._open:
            self._close()

    def _read(self, html: str) -> None:
        at = 0
        while found := _TOKEN.search(html, at):
            self._text(html[at : found.start()])
            at = found.end()
            name = found["name"]
            if name is None:
                continue
            name = name.lower()
            if found["end"]:
                self._end(name)
            else:
                self._start(name, found["attributes"])
                if name in RAW:
                    end = _RAW_END[name].search(html, at)
                    at = end.end() if end else len(html)
                    self._end(name)
        self._text(html[at:])

    def _text(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            self.breaks.append(False)
            self._parts[-1].append(" ".join(text.split()).encode("utf-8", "surrogatepass"))

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self._counts[name]:
            return
        if name in ENDS_P and self._counts["p"]:
            self._end("p")
        if name in HEADINGS and self.elements[self._open[-1]].tag in HEADINGS:
            self._close()
        if name in ENDS:
            closed, within = ENDS[name]
            for depth in range(self._border(within), len(self._open)):
                if self.elements[self._open[depth]].tag in closed:
                    while len(self._open) > depth:
                        self._close()
                    break
        if name in BLOCKS:
            self.breaks[-1] = True
        if name == "br":
            self._text(" ")
        if name in VOID:
            return
        names = role = ""
        if attributes and not attributes.isspace():
            for key, *values in _ATTRIBUTE.findall(attributes):
                value = "".join(values)
                if key.lower() in ("class", "id"):
                    names += " " + unescape(value)
                elif key.lower() == "role":
                    role = value.strip().lower()
        self.elements.append(Element(name, self._open[-1], names, role, len(self.pieces)))
        self._open.append(len(self.elements) - 1)
        self._counts[name] += 1
        self._parts.append([])

    def _border(self, within: set[str]) -> int:
        """Depth above the innermost open element of ``within``."""
        for depth in range(len(self._open) - 1, 0, -1):
            if self.elements[self._open[depth]].tag in within:
                return depth + 1
        return 1

    def _end(self, name: str) -> None:
        if not self._counts[name] or name in ("html", "body"):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.elements[self._open[depth]].tag
            if tag == name:
                while len(self._open) > depth:
                    self._close()
                return
            if tag in SCOPE and name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption") or (
                tag in BLOCKS and name not in BLOCKS
            ):
                return

    def _close(self) -> None:
        element = self.elements[self._open.pop()]
        parts = self._parts.pop()
        element.last = len(self.pieces)
        if element.tag:
            self._counts[element.tag] -= 1
            element.digest = blake2b(b"\0".join([element.tag.encode("utf-8", "surrogatepass"), *filter(None, parts)]), digest_size=16).digest()
            if any(parts):
                self._parts[-1].append(b"\1" + element.digest)
            if element.tag in BLOCKS:
                self.breaks[-1] = True


def blocks(pieces: list[str], breaks: list[bool], kept: list[bool]) -> list[str]:
    """Texts of the blocks of the pieces that are kept, white space as one blank, empty ones left out."""
    out, now = [], []
    for piece, new, keep in zip(pieces, breaks, kept):
        if new and now:
            out.append(" ".join("".join(now).split()))
            now = []
        if keep:
            now.append(piece)
    out.append(" ".join("".join(now).split()))
    return [b for b in out if b]
