"""Main text of web pages with a site style tree: what a host's pages have in common, by entropy, is not content."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tongues.sources.scratch import stored

#: A branch goes when its importance is below this, on hosts with at least so many pages that have it.
THRESHOLD, LEAST_PAGES = 0.2, 5
#: Weight of what lies below a node against the node's own variety of layouts, to the power of their number.
DECAY = 0.9
#: Levels of the style tree that are told apart; deeper elements count with their ancestor at this level.
DEPTH = 64
#: Unimportant branches are broadcast up to this many bytes and joined by host beyond.
BROADCAST = 16 << 20

#: Elements whose text is never part of an article.
NEVER = frozenset(
    "head title script style noscript template iframe object svg canvas audio video map nav footer aside form button "
    "select option textarea input label dialog menu datalist".split()
)
#: Names in class or id, and roles, that mark what is not the article.
NOT_CONTENT = frozenset(
    "nav navbar navigation menu masthead footer sidebar aside ad ads advert adverts advertisement adsense banner sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login search share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar widget hidden".split()
)
#: Names of what readers say. No article inside such an element is the page's article.
COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
#: What may stand around such names, as in site-header, left-sidebar or comments-section; beside anything else, as in comments-open, has-sidebar or
#: related-work, a name is not known to mean what it holds.
STRUCTURE = frozenset(
    "site page main global primary secondary left right top bottom upper lower user reader site wide sticky fixed inner outer "
    "bar box area block list item items links link buttons button posts post articles stories form section wrapper wrap container holder slot "
    "thread body tools row column col panel group unit zone region module widgets icons inline text title heading count".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Elements that never make a block of their own.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Paragraph-like elements: inside an article they stay even if their text repeats all over the site.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table tbody thead tr td th dl dt dd ol ul li figure figcaption".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
_HOLDERS = frozenset("body main article section div td th table form blockquote aside nav header footer ul ol li".split())
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)""",
    re.S,
)
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"\d+")


@dataclass
class Mark:
    """An element whose class or id says that it is not content, and the most text of an article or main element in it, without that of an article in a main."""

    holds: int = 0


@dataclass
class Node:
    """An open element: its place in the style tree, and whether text below it may be content.

    ``marks`` are the elements around it that their names rule out, and ``size`` the text so far in an article or main element.
    """

    tag: str
    key: int
    depth: int
    ruled_out: bool
    region: str
    around: tuple[int, ...] = ()
    marks: tuple[Mark, ...] = ()
    prose: bool = False
    size: int = 0
    children: list[int] = field(default_factory=list)
    text: xxhash.xxh64 = field(default_factory=xxhash.xxh64)


@dataclass
class Block:
    """Text of one block, its region, the keys of the elements around it that entropy may remove, those that names rule out,
    and whether it is of a paragraph-like element."""

    text: str
    region: str
    around: tuple[int, ...]
    marks: tuple[Mark, ...] = ()
    prose: bool = False


def _hash(*parts: object) -> int:
    return int.from_bytes(xxhash.xxh64_digest("\x1f".join(map(str, parts))), "big", signed=True)


def _means(name: list[str], words: frozenset[str]) -> bool:
    """Whether the parts of a class or id are some of ``words`` and otherwise tell only where or how the element stands."""
    return any(part in words for part in name) and all(part in words or part in STRUCTURE for part in name)


class Page:
    """One pass over a page's tags: blocks of text, and what the page adds to the site style tree."""

    def __init__(self, html: str):
        self.blocks: list[Block] = []
        self.seen: dict[int, list[tuple[int, int]]] = {}
        self.parts: list[str] = []
        self.open: Counter[str] = Counter()
        self.largest = 0
        self.stack = [Node("", _hash("root"), 0, False, "")]
        at, end = 0, len(html)
        while at < end:
            m = _TOKEN.search(html, at)
            self._data(html[at:m.start()] if m else html[at:])
            if not m:
                break
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self._close(tag)
                else:
                    self._open(tag, m[3])
                    if tag in _RAW and not m[3].endswith("/>"):
                        stop = _RAW[tag].search(html, at)
                        at = stop.start() if stop else end
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        # the article or main element with the most text is not ruled out by the name of what holds it
        self.blocks = [b for b in self.blocks if all(m.holds and m.holds == self.largest for m in b.marks)]

    def _data(self, text: str) -> None:
        if text:
            node = self.stack[-1]
            if not node.ruled_out:
                self.parts.append(unescape(text))
            words = text.split()
            if words:
                node.text.update(" ".join(words))

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                node = self.stack[-1]
                self.blocks.append(Block(text, node.region, node.around, node.marks, node.prose))
                node.size += len(text)

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag in INLINE or tag in VOID:
            if tag not in INLINE:
                self.stack[-1].children.append(_hash(tag))
            return
        self._flush()
        if tag in _CLOSES:
            self._imply(_CLOSES[tag], _SCOPES[tag])
        else:
            self._imply({"p"}, _HOLDERS - {"p"})
        parent = self.stack[-1]
        named = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
        label = f"{tag}.{' '.join(sorted(_NUMBER.sub('0', named.get('class', '')).split()))}#{_NUMBER.sub('0', named.get('id', ''))}"
        role = named.get("role", "")
        names = [_WORD.findall(name) for name in f"{named.get('class', '')} {named.get('id', '')}".split()]
        region = parent.region or ("article" if tag == "article" else "main" if tag == "main" or role == "main" else "")
        if parent.region == "main" and tag == "article":
            region = "article"
        out = parent.ruled_out or tag in NEVER or role in ROLES
        if tag not in ("html", "body", "main"):
            out = out or any(_means(name, COMMENTS) for name in names)
        marked = tag == "header" and not parent.region
        if tag not in ("html", "body", "main", "article") and role != "main":
            known = NOT_CONTENT if parent.region else NOT_CONTENT | {"header"}
            marked = marked or any(_means(name, known) for name in names)
        deep = parent.depth >= DEPTH
        node = Node(tag, parent.key if deep else _hash(parent.key, label), parent.depth + (not deep), out, region, parent.around, parent.marks, parent.prose or tag in PROSE)
        if marked:
            node.marks += (Mark(),)
        if not deep and not (region and tag in PROSE) and tag not in ("html", "body", "main", "article"):
            node.around += (node.key,)
        parent.children.append(_hash(label))
        self.stack.append(node)
        self.open[tag] += 1

    def _imply(self, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        """Close an open element that the next one ends, if it lies in the same scope."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i].tag in scope:
                return

    def _close(self, tag: str) -> None:
        if tag in INLINE or tag in VOID or not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._flush()
                while len(self.stack) > i:
                    self._pop()
                return
            if tag == "p" and self.stack[i].tag in _HOLDERS:
                return

    def _pop(self) -> None:
        self._flush()
        node = self.stack.pop()
        self.open[node.tag] -= 1
        if node.region == self.stack[-1].region:
            self.stack[-1].size += node.size
        else:
            self.largest = max(self.largest, node.size)
            for mark in node.marks:
                mark.holds = max(mark.holds, node.size)
        content = int.from_bytes(node.text.digest(), "big", signed=True)
        self.stack[-1].text.update(node.text.digest())
        self.seen.setdefault(node.key, []).append((_hash(*node.children), content))

    def style(self) -> Iterator[tuple[int, int, int]]:
        """``(node, layout, content)`` once for each style-tree node of the page."""
        for key, seen in self.seen.items():
            yield key, _hash(*[a for a, _ in seen]), _hash(*[b for _, b in seen])

    def words(self) -> int:
        """A hash of all text that is not ruled out: pages of a host that agree in it are copies of one page."""
        return _hash(*[b.text for b in self.blocks])

    def main_text(self, unimportant: frozenset[int]) -> str:
        """Blocks of the region where most of the text is, without removed branches.

        With most in articles, these are theirs and the paragraph-like ones of main around them; with most in main, main's and the articles'; and
        with most outside of both, all.
        """
        blocks = [b for b in self.blocks if not unimportant.intersection(b.around)]
        sizes = Counter()
        for b in blocks:
            sizes[b.region] += len(b.text)
        if sizes["article"] + sizes["main"] >= sizes[""]:
            whole = sizes["main"] > sizes["article"]
            blocks = [b for b in blocks if b.region == "article" or b.region == "main" and (whole or b.prose)]
        return " ".join(b.text for b in blocks)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _hosts(pages: DataFrame) -> DataFrame:
    """Pages with ``host``; a missing or malformed address has the empty host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = pa.array([host_of(u.as_py()) for u in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, hosts], [*batch.schema.names, "host"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, html string, host string")


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, node, pages, importance``: the site style trees of all hosts, merged from their pages.

    A node is an element's path of tags, classes and ids. With ``m`` pages that have it, the importance of its
    layouts is the entropy of their shares to the base ``m``, and that of its content likewise:
    0 when all pages agree, 1 when no two do. With ``l`` layouts the two are mixed as
    ``(1 - DECAY**l) * layouts + DECAY**l * content``. Pages of equal text, whatever is ruled out in them, are one page: copies are
    no evidence of what a site repeats. Of their layouts and contents the smallest hashes count. No host or node is
    gathered in one task, so a host may have any number of pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, pages, nodes, layouts, contents = [], [], [], [], []
            for url, html in zip(batch.column(0), batch.column(1)):
                host, page = host_of(url.as_py()), Page(html.as_py() or "")
                words = page.words()
                for node, layout, content in page.style():
                    hosts.append(host)
                    pages.append(words)
                    nodes.append(node)
                    layouts.append(layout)
                    contents.append(content)
            longs = [pa.array(x, pa.int64()) for x in (pages, nodes, layouts, contents)]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *longs], ["host", "page", "node", "layout", "content"])

    seen = pages.select("url", "html").mapInArrow(run, "host string, page long, node long, layout long, content long")
    seen = seen.groupBy("host", "page", "node").agg(F.min("layout").alias("layout"), F.min("content").alias("content"))
    seen = seen.select("host", "node", F.posexplode(F.array("layout", "content")).alias("kind", "hash"))
    counted = seen.groupBy("host", "node", "kind", "hash").agg(F.count(F.lit(1)).alias("c"))
    sums = counted.groupBy("host", "node", "kind").agg(
        F.sum("c").alias("m"), F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("clogc"), F.count(F.lit(1)).alias("l")
    )
    entropy = F.when(F.col("m") > 1, 1.0 - F.col("clogc") / (F.col("m") * F.log(F.col("m").cast("double")))).otherwise(1.0)
    sums = sums.withColumn("entropy", entropy)
    both = sums.groupBy("host", "node").agg(
        F.max("m").alias("pages"),
        F.max(F.when(F.col("kind") == 0, F.col("entropy"))).alias("layout"),
        F.max(F.when(F.col("kind") == 0, F.col("l"))).alias("layouts"),
        F.max(F.when(F.col("kind") == 1, F.col("entropy"))).alias("content"),
    )
    below = F.pow(F.lit(DECAY), F.col("layouts"))
    return both.select("host", "node", "pages", ((1.0 - below) * F.col("layout") + below * F.col("content")).alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``; null html is empty, and so is its text.

    Elements that are never part of an article, and those whose role, class or id says so, are ruled out first. A class or id of layout does
    not rule out the article or main element with the most text, nor what holds it; one of reader comments does, and their articles are none.
    Then the branches go whose importance in the host's style tree is low, except paragraphs, headings,
    lists and tables inside an article, which repeat where pages are copies of one another. The text
    is of the articles and of main's paragraphs around them, or of all of main, or of the whole body, by where most of it is. Blocks are
    joined by a space. Repeated rows and copies of a page do no harm, as they count once in the style tree, nor do clashing
    columns: three columns are read.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    tree = style_tree(pages).filter((F.col("importance") < THRESHOLD) & (F.col("pages") >= LEAST_PAGES))
    low = stored(tree.groupBy("host").agg(F.collect_list("node").alias("low")), "style-low")
    size = low.agg(F.sum(F.size("low") * 8 + F.octet_length("host") + 32)).first()[0] or 0
    joined = _hosts(pages).join(F.broadcast(low) if size <= BROADCAST else low, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, nodes in zip(batch.column(2), batch.column(3)):
                texts.append(Page(html.as_py() or "").main_text(frozenset(nodes.as_py() or ())))
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "low").mapInArrow(run, "page_id long, url string, text string, n_chars long")
