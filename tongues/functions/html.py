"""Reading one HTML page: its visible text, element ranges and links.

The visible text of a page is kept as one string; an element is a ``(start, end)``
range of it. Nested elements are overlapping ranges, so a page whose ``<p>`` tags
are never closed costs no more memory than its text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

# Tags that never hold content, and tags whose text is not page text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
SILENT = frozenset("rp rt script style template".split())

_SELECTOR = re.compile(r'([\w-]*)(?:\.([\w-]+)|\[class\*="([^"]+)"\])?')
_BREAK = re.compile(r"(?<=[.!?])\s+")


@lru_cache(maxsize=4096)
def _selector(text: str) -> tuple[str, str, str]:
    """Split ``tag``, ``tag.class`` or ``[class*="part"]`` into its three parts."""
    found = _SELECTOR.fullmatch(text)
    if not text or not found:
        raise ValueError(f"unsupported selector: {text!r}")
    tag, cls, part = found.groups(default="")
    return tag.lower(), cls, part


def _matches(selector: str, tag: str, classes: list[str]) -> bool:
    want, cls, part = _selector(selector)
    if want and want != tag:
        return False
    if cls and cls not in classes:
        return False
    return not part or part in " ".join(classes)


Rule = tuple[tuple[str, ...], tuple[str, ...]]  # selectors to include and to exclude
_MEMORY = 50_000


class Selection:
    """Several rules as one: which of their selectors an element matches, remembered by its tag and classes."""

    def __init__(self, rules: Sequence[Rule] = ()):
        self.excluded = list(dict.fromkeys(tuple(exclude) for _, exclude in rules))
        self.rules = [(tuple(include), self.excluded.index(tuple(exclude))) for include, exclude in rules]
        self.memory: dict[tuple[str, str], tuple[list[int], list[tuple[int, int]]]] = {}

    def of(self, tag: str, names: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Exclusions that hide the element, and ``(rule, selector)`` pairs that include it."""
        found = self.memory.get((tag, names))
        if found is None:
            classes = names.split()
            hides = [k for k, selectors in enumerate(self.excluded) if any(_matches(s, tag, classes) for s in selectors)]
            takes = [(r, i) for r, (include, _) in enumerate(self.rules) for i, s in enumerate(include) if _matches(s, tag, classes)]
            found = hides, takes
            if len(self.memory) >= _MEMORY:
                self.memory.clear()
            self.memory[tag, names] = found
        return found


class PageReader(HTMLParser):
    """One pass over a page for any number of rules: its text, its links, and the ranges that each rule selects or hides.

    An end tag closes up to the nearest open tag of its name and is ignored when
    there is none; no tag closes another one implicitly. The text is that of the whole page; what a rule
    excludes is a range of it.
    """

    def __init__(self, selection: Selection):
        super().__init__(convert_charrefs=False)
        self.selection = selection
        self.pieces: list[str] = []
        self.size = 0
        self.open: list[tuple[str, list[list], list[int], bool]] = []  # name, ranges, exclusions, silent
        self.open_names: dict[str, int] = {}
        self.depth = [0] * len(selection.excluded)
        self.silent = 0
        self.hidden: list[list[list[int]]] = [[] for _ in selection.excluded]  # outermost hidden [start, end]
        self.ranges: list[list[list[int]]] = [[] for _ in selection.rules]  # [selector, start, end]
        self.links: list[list] = []  # [href, start, end]

    def handle_starttag(self, tag, attrs):
        names, href = "", None
        for name, value in attrs:
            if name == "class":
                names = value or ""
            elif name == "href":
                href = value or ""
        hides, takes = self.selection.of(tag, names)
        started: list[list] = []
        for k in hides:
            if not self.depth[k]:
                self.hidden[k].append([self.size, self.size])
            self.depth[k] += 1
        for r, i in takes:
            if not self.depth[self.selection.rules[r][1]]:
                item = [i, self.size, self.size]
                self.ranges[r].append(item)
                started.append(item)
        if tag == "a" and href is not None:
            item = [href, self.size, self.size]
            self.links.append(item)
            started.append(item)
        if tag in VOID:
            self._end(started, hides)
            return
        silent = tag in SILENT
        self.silent += silent
        self.open.append((tag, started, hides, silent))
        self.open_names[tag] = self.open_names.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        while self.open_names.get(tag):
            name, started, hides, silent = self.open.pop()
            self.open_names[name] -= 1
            self.silent -= silent
            self._end(started, hides)
            if name == tag:
                return

    def _end(self, started, hides):
        for item in started:
            item[2] = self.size
        for k in hides:
            self.depth[k] -= 1
            self.hidden[k][-1][1] = self.size

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append(data)
            self.size += len(data)

    def handle_charref(self, name):
        self.handle_data(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        decoded = unescape(f"&{name};")
        self.handle_data(f"&{name}" if decoded == f"&{name};" else decoded)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])

    def read(self, html: str) -> str:
        self.feed(html)
        self.close()
        for _, started, hides, _ in reversed(self.open):
            self._end(started, hides)
        return "".join(self.pieces)


def page_links(html: str) -> list[tuple[str, str]]:
    """``(href, lower-cased text)`` of every link, in document order."""
    reader = PageReader(Selection())
    text = reader.read(html)
    return [(href, text[start:end].lower()) for href, start, end in reader.links]


def _trimmed(text: str, ranges: list[list[int]], hidden: list[list[int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without what is hidden, and the non-blank ranges in it, selector by selector and in document order."""
    cuts = [h for h in hidden if h[1] > h[0]]
    if cuts:
        starts = [c[0] for c in cuts]
        lost = [0]
        for start, end in cuts:
            lost.append(lost[-1] + end - start)
        text = "".join(text[a:b] for a, b in zip([0, *(c[1] for c in cuts)], [*starts, len(text)]))
        # no range starts inside of what is hidden from its rule, and none ends there
        ranges = [[i, a - lost[bisect_right(starts, a - 1)], b - lost[bisect_right(starts, b - 1)]] for i, a, b in ranges]
    trimmed = []
    for _, start, end in sorted(ranges, key=lambda r: r[0]):  # stable: document order within a selector
        body = text[start:end]
        left = len(body) - len(body.lstrip())
        stop = len(body.rstrip())
        if left < stop:
            trimmed.append((start + left, start + stop))
    return text, trimmed


def paragraphs(html: str, include, exclude):
    """Trimmed text of every matching element, selector by selector."""
    reader = PageReader(Selection([(tuple(include), tuple(exclude))]))
    text, ranges = _trimmed(reader.read(html), reader.ranges[0], reader.hidden[0])
    for start, end in ranges:
        yield text[start:end]


def sentence_pieces(html: str, include, exclude, max_length: int):
    """``distinct_pieces`` of what one rule selects."""
    reader = PageReader(Selection([(tuple(include), tuple(exclude))]))
    return distinct_pieces(*_trimmed(reader.read(html), reader.ranges[0], reader.hidden[0]), max_length)


def read_page(html: str, selection: Selection, max_length: int) -> tuple[str, list[tuple[str, int, int]], dict[str, int]]:
    """The texts of a page's links, its links as ``(href, start, size)`` in them, and its sentences with the rules that select them.

    Links whose ranges overlap share their text, so links that are never closed cost no more than the page. Rules are bits of a
    number in the order of ``selection``; those that select the same ranges are worked out once.
    """
    reader = PageReader(selection)
    text = reader.read(html)
    parts, shift, upto, moved = [], 0, 0, {}
    for _, start, end in reader.links:  # in order of their starts
        if start > upto:
            shift += start - upto
            upto = start
        moved[start] = start - shift
        if end > upto:
            parts.append(text[upto:end])
            upto = end
    links = [(href, moved[start], end - start) for href, start, end in reader.links]
    alike: dict[tuple, int] = {}
    for r, (_, k) in enumerate(selection.rules):
        if reader.ranges[r]:
            key = k, tuple(map(tuple, reader.ranges[r]))
            alike[key] = alike.get(key, 0) | 1 << r
    sentences: dict[str, int] = {}
    for (k, ranges), rules in alike.items():
        for piece in distinct_pieces(*_trimmed(text, ranges, reader.hidden[k]), max_length):
            sentences[piece] = sentences.get(piece, 0) | rules
    return "".join(parts), links, sentences


def distinct_pieces(text: str, ranges: list[tuple[int, int]], max_length: int):
    """Distinct sentences of all ranges of a text, white space collapsed.

    Overlapping ranges share their inner sentences, which are emitted once: the
    work stays linear in the text. Pieces longer than ``max_length`` are left out.
    """
    breaks = [m.span() for m in _BREAK.finditer(text)]
    starts = [b[0] for b in breaks]
    inner = [0] * (len(breaks) + 1)
    spans = set()
    for start, end in set(ranges):
        lo, hi = bisect_right(starts, start), bisect_left(starts, end)
        if lo >= hi:
            spans.add((start, end))
            continue
        spans.add((start, breaks[lo][0]))
        spans.add((breaks[hi - 1][1], end))
        inner[lo] += 1
        inner[hi - 1] -= 1
    depth = 0
    for i in range(len(breaks) - 1):
        depth += inner[i]
        if depth:
            spans.add((breaks[i][1], breaks[i + 1][0]))
    visible = None
    seen = set()
    for start, end in sorted(spans):
        if end - start > 4 * max_length:
            if visible is None:  # running count of characters that survive collapsing
                visible = [0]
                for c in text:
                    visible.append(visible[-1] + (not c.isspace()))
            if visible[end] - visible[start] > max_length:
                continue
        piece = " ".join(text[start:end].split())
        if len(piece) <= max_length and piece not in seen:
            seen.add(piece)
            yield piece
