"""The main text of web pages, by tag path ratios.

A page is read as blocks: runs of text between block-level tags, each with its
path of tags from the root. Blocks in places that are never content (menus,
adverts, told by tag and role) are left out. Forms, and elements whose class or
id has a word such as "comments", are doubtful. They are left out whatever their
size, but for those that hold the article: if every <article> and <main> lies in
doubtful elements, the ones around the least doubtful of them are taken for the
page's frame (a lone one that is not among comments, a <main>, or one with an
<h1>), and if nothing else is left, the ones around the least doubtful blocks, the
<h1> first. Comments are more doubtful than anything else.

For the other blocks, text length and punctuation are summed per path and divided
by the path's blocks. These ratios are smoothed along the page, fused with the
path's own, and paths above a threshold are content. The element that holds nearly
all of their text is the article; all its blocks are its text, short ones included,
and so are headings right before a kept block and, on pages where it is in no
<article> or <main>, the blocks of content paths elsewhere.

Each page is read by itself in one pass over its tags, in time and memory in
proportion to it, however its tags are nested or left open. A null or empty page
has an empty text. What is not markup is text; a tag that the end of the page cuts
off is dropped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\s*(?:[^\s\"'>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]*))?|[\"'=]))*)\s*(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'>=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split())
_CLOSES_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
_HOLDERS = frozenset("ul ol dl table article section div body main aside nav form".split())

# Never content, by tag, by role, and by words in class and id.
_ASIDE_TAGS = frozenset(
    "head nav aside footer script style noscript template iframe svg math button select textarea object canvas dialog "
    "menu audio video map title input datalist".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar alert "
                         "status toolbar tablist".split())
_ASIDE_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising advertorial banner sponsor sponsored sponsors promo "
    "promos promotion promoted cookie cookies consent gdpr notice notices notification popup modal overlay lightbox "
    "newsletter subscribe subscription signup share sharing social comment comments commentlist disqus replies reply "
    "respond discussion sidebar sidebars menu menus navbar nav navigation breadcrumb breadcrumbs pagination pager related "
    "recommended recommendations recommendation trending popular widget widgets footer masthead login toolbar topbar "
    "skip search searchform alert hidden copyright crumbs responses feedback".split())
# The head of an article is content, that of a site is not.
_ARTICLE_WORDS = frozenset("article content entry post story".split())
_COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
_ROOTS = frozenset("html body main article".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A word after one of these says how the page is laid out, not what the element is.
_LAYOUT_WORDS = frozenset("no not with without has".split())

SHARE = 0.9
ASIDE, COMMENT = 1, 2  # kinds of doubtful elements
# Where the walks back over open elements stop: see ``_Reader``.
_ENDS_P = frozenset({"p"}) | _HOLDERS
_ENDS_OWN = frozenset().union(*_CLOSES_OWN.values()) | {"ul", "ol", "dl", "table", "select"}


@dataclass(eq=False)
class Node:
    """An element. What depends on the elements around it is noted when it opens."""

    tag: str
    parent: Node | None
    aside: bool = False
    doubt: int = 0
    number: int = 0  # in order of opening
    path: int = 0  # equal for equal tag paths
    article: Node | None = None  # the innermost <article> or <main> that is not doubtful
    in_article: bool = False  # in any <article> or <main>, itself included
    aside_at: int = 0  # depth of the outermost aside element that is no template
    open: bool = True
    last: int = 0  # number of the last element in it
    text: int = 0  # content text of all blocks in it
    frame: bool = False  # holds the article, so its doubt doesn't count
    doubts: tuple[int, int] = (0, 0)  # doubtful elements around: comments, all

    @property
    def holder(self) -> Node:
        return self._holder

    def __post_init__(self) -> None:
        above = self.parent
        self._holder = self if above is None or self.tag not in _INLINE or self.doubt else above.holder

    def inside(self, other: Node) -> bool:
        return other.number <= self.number <= other.last


@dataclass
class Block:
    node: Node
    text: str


def _is_aside(tag: str, attributes: str, parent: Node) -> bool:
    if tag in _ASIDE_TAGS or tag == "header" and not parent.in_article:
        return True
    if not attributes.strip():
        return False
    names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in names or names.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", names.get("style", ""), re.IGNORECASE):
        return True
    if names.get("role", "").lower() in _ASIDE_ROLES:
        return True
    return False


def _words(value: str) -> set[str]:
    found = set()
    for token in value.split():
        before = ""
        for word in map(str.lower, _WORD.findall(token)):
            if before not in _LAYOUT_WORDS:
                found.add(word)
            before = word
    return found


def _doubt(tag: str, attributes: str, parent: Node) -> int:
    names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    if tag == "form" or names.get("role", "").lower() == "form":
        return ASIDE
    if not names or tag in ("html", "body") or tag in _HEADINGS and parent.in_article:
        return 0
    words = _words(names.get("class", ""))
    if not (tag in _HEADINGS or tag == "section" and parent.in_article):  # their ids are made from titles
        words |= _words(names.get("id", ""))
    if words & _COMMENT_WORDS:
        return COMMENT
    if tag in _ROOTS:
        return 0
    site_header = "header" in words and not words & _ARTICLE_WORDS and not parent.in_article
    return ASIDE if words & _ASIDE_WORDS or site_header else 0


def _count_doubts(nodes: list[Node]) -> None:
    """Doubtful elements around each, itself included. One that was never closed ends where an article begins."""
    total: list[tuple[int, int, int, int]] = []  # of closed ones, then of open ones: comments, all
    for node in nodes:
        closed_comments, closed, open_comments, opened = total[node.parent.number] if node.parent else (0, 0, 0, 0)
        if node.doubt and not node.frame:
            comment = node.doubt == COMMENT
            if node.open:
                open_comments, opened = open_comments + comment, opened + 1
            else:
                closed_comments, closed = closed_comments + comment, closed + 1
        total.append((closed_comments, closed, open_comments, opened))
        ended = total[node.article.number] if node.article else (0, 0, 0, 0)
        node.doubts = (closed_comments + open_comments - ended[2], closed + opened - ended[3])


def _frame(places: list[Node]) -> None:
    """What lies around the least doubtful of these is the page's frame; around its title, if one is among them."""
    least = min(n.doubts for n in places)
    places = [n for n in places if n.doubts == least]
    for place in [n for n in places if n.tag == "h1"] or places:
        node: Node | None = place
        while node and not node.frame:
            node.frame = True
            node = node.parent


def _settled(blocks: list[Block], nodes: list[Node]) -> list[Block]:
    """``blocks`` without those in doubtful elements."""
    _count_doubts(nodes)
    held = {b.node.article.number: b.node.article for b in blocks if b.node.article}
    titled = {b.node.article.number for b in blocks if b.node.article and b.node.tag == "h1"}
    if held and all(n.doubts > (0, 0) for n in held.values()):
        # A lone <article> may be a comment or a teaser, unless it has the page's title.
        articles = [n for n in held.values() if n.tag == "main" or n.number in titled or len(held) == 1 and not n.doubts[0]]
        if articles:
            _frame(articles)
            _count_doubts(nodes)
    if blocks and all(b.node.doubts > (0, 0) for b in blocks):
        _frame([b.node for b in blocks])
        _count_doubts(nodes)
    return [b for b in blocks if b.node.doubts == (0, 0)]


class _Reader:
    """Open elements of a page. Where each tag is open is kept, so that no step walks over all of them."""

    def __init__(self) -> None:
        self.nodes = [Node("", None)]
        self.stack = [self.nodes[0]]
        self.at: dict[str, list[int]] = {}  # depths at which a tag is open
        self.ends_p: list[int] = []
        self.ends_own: list[int] = []
        self.paths: dict[tuple[int, str], int] = {}

    def depth(self, tag: str) -> int:
        """The innermost depth at which the tag is open, or 0."""
        found = self.at.get(tag)
        return found[-1] if found else 0

    def close(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.at[node.tag].pop()
        del self.stack[depth:]
        for ends in (self.ends_p, self.ends_own):
            while ends and ends[-1] >= depth:
                ends.pop()

    def close_implied(self, tag: str) -> None:
        """What a new element of this tag ends."""
        if tag == "body" or (self.stack[-1].tag == "head" and tag not in (
                "meta", "link", "title", "script", "style", "base", "noscript", "template")):
            if head := self.at.get("head"):
                self.close(head[0])
        if tag in ("article", "main"):  # an advert or menu that was never closed ends here
            depth = self.stack[-1].aside_at
            if depth and self.depth("aside") < depth:
                self.close(depth)
        if tag in _CLOSES_P and self.ends_p and self.stack[self.ends_p[-1]].tag == "p":
            self.close(self.ends_p[-1])
        if tag in _CLOSES_OWN:
            for depth in reversed(self.ends_own):  # few: each of these tags ends the one before it
                if self.stack[depth].tag in _CLOSES_OWN[tag]:
                    self.close(depth)
                    break
                if self.stack[depth].tag in ("ul", "ol", "dl", "table", "select"):
                    break

    def element(self, tag: str, attributes: str) -> Node:
        above = self.stack[-1]
        aside = above.aside or _is_aside(tag, attributes, above)
        doubt = 0 if aside else _doubt(tag, attributes, above)
        node = Node(tag, above, aside, doubt, len(self.nodes), self.paths.setdefault((above.path, tag), len(self.paths) + 1))
        self.nodes.append(node)
        node.article, node.in_article = above.article, above.in_article or tag in ("article", "main")
        if tag in ("article", "main") and not doubt and not aside:
            node.article = node
        node.aside_at = above.aside_at or (len(self.stack) if aside and tag not in ("template", "noscript") else 0)
        return node

    def open(self, node: Node) -> None:
        depth = len(self.stack)
        self.at.setdefault(node.tag, []).append(depth)
        if node.tag in _ENDS_P:
            self.ends_p.append(depth)
        if node.tag in _ENDS_OWN:
            self.ends_own.append(depth)
        self.stack.append(node)


def blocks_of(page: str) -> tuple[list[Block], list[Node]]:
    """The page's text blocks outside places that are no content, and all its elements."""
    reader = _Reader()
    found, parts = [], []
    at, end, last_close = 0, len(page), page.rfind(">")

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append(Block(reader.stack[-1].holder, text))

    while at < end:
        sign = page.find("<", at)
        if sign < 0:
            sign = end
        if sign > at and not reader.stack[-1].aside:
            parts.append(page[at:sign])
        if sign == end:
            break
        token = _TOKEN.match(page, sign)
        if not token:
            if last_close < sign and re.match(r"</?[a-zA-Z!?]", page[sign : sign + 3]):
                break
            if not reader.stack[-1].aside:
                parts.append("<")
            at = sign + 1
            continue
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if tag not in _INLINE:
            flush()
        elif tag == "br" and not reader.stack[-1].aside:
            parts.append(" ")
        if token[1]:
            if depth := reader.depth(tag):
                reader.stack[depth].open = False
                reader.close(depth)
            continue
        reader.close_implied(tag)
        if tag in _VOID:
            continue
        node = reader.element(tag, token[3] or "")
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = page.find(">", stop.start()) + 1 or end if stop else end
            continue
        if not token[0].rstrip(">").endswith("/") or tag not in ("svg", "math", "path"):
            reader.open(node)
    flush()
    return _settled([b for b in found if not b.node.aside], reader.nodes), reader.nodes


def content_paths(blocks: list[Block]) -> set[int]:
    """Paths whose fused ratio is above the page's threshold."""
    paths = [b.node.path for b in blocks]
    sums: dict[int, list[float]] = {}
    for path, block in zip(paths, blocks, strict=True):
        total = sums.setdefault(path, [0, 0, 0])
        total[0] += len(block.text)
        total[1] += len(_PUNCTUATION.findall(block.text))
        total[2] += 1
    ratio = {p: (length / n) * (1 + marks / n) for p, (length, marks, n) in sums.items()}
    along = [ratio[p] for p in paths]
    smooth = [sum(along[max(0, i - 1) : i + 2]) / len(along[max(0, i - 1) : i + 2]) for i in range(len(along))]
    fused: dict[int, float] = {}
    for path, value in zip(paths, smooth, strict=True):
        fused[path] = fused.get(path, 0) + value / sums[path][2]
    fused = {p: (value * ratio[p]) ** 0.5 for p, value in fused.items()}
    threshold = sum(fused.values()) / len(fused) / 2
    return {p for p, value in fused.items() if value >= threshold}


def _place(nodes: list[Node], total: int) -> tuple[Node, bool]:
    """The element that holds nearly all content text, or the article around it, and whether it is one."""
    below: dict[int, Node] = {}  # the first child that holds so much
    for node in reversed(nodes):
        if node.parent:
            node.parent.text += node.text
            if node.tag in _HOLDERS and node.text >= SHARE * total:
                below[node.parent.number] = node
    place = nodes[0]
    while place.number in below:
        place = below[place.number]
    around: Node | None = place
    while around and around.tag not in ("article", "main"):
        around = around.parent
    return around or place, around is not None


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by line ends."""
    blocks, nodes = blocks_of(page or "")
    if not blocks:
        return ""
    chosen = content_paths(blocks)
    for node in reversed(nodes):
        node.last = max(node.last, node.number)
        if node.parent:
            node.parent.last = max(node.parent.last, node.last)
    total = 0
    for block in blocks:
        if block.node.path in chosen:
            total += len(block.text)
            block.node.text += len(block.text)
    place, article = _place(nodes, total)
    keep = [b.node.inside(place) or not article and b.node.path in chosen for b in blocks]
    for i in range(len(blocks) - 2, -1, -1):
        keep[i] = keep[i] or keep[i + 1] and blocks[i].node.tag in _HEADINGS
    kept = [b for b, k in zip(blocks, keep, strict=True) if k]
    if not any(b.node.tag == "h1" for b in kept):
        kept = [b for b in blocks[: keep.index(True)] if b.node.tag == "h1"][-1:] + kept
    return "\n".join(b.text for b in kept)


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            batch.columns[:-1] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=batch.schema.names[:-1] + ["text", "n_chars"])


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` and ``n_chars``; columns of these names are replaced."""
    carried = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*carried, F.col(html_col).alias("html"))
    schema = pages.select(*carried).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extracted, schema)
