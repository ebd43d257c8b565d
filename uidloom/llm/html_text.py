"""Main text of web pages by removal of site templates.

Each page is parsed into elements, and every element, those of the main content included, gets two hashes of its
subtree: one of tag, class, id, texts and the hashes of its children, and one of its shape, which leaves out the texts.
Spark counts on how many pages of its host each subtree occurs. Subtrees that recur are the site's template and are
deleted (see ``extract`` for how often). Plain paragraphs, titles and other text without class, id or role count as
templates outside marked content only, and only by their exact text: sites repeat paragraphs, and these are content.

What the counts leave goes through rules that need no other page. Elements whose tag, role or class says that they are
menus, headers, footers, sidebars, notices, adverts, forms or comments go on pages of any host. A compound
class such as ``right-sidebar`` drops an element only if it does not stand around the content. ``main`` is kept with
the articles, or else the page's only article, or else the whole page; if one of several articles, or one in main, has
more than half of that text, only the articles and the main titles beside them are kept.

Defined results: a null or empty page gives an empty text; a null or odd url has no host, so nothing of it
counts as a template; repeated rows count as pages and each gets its own result; very long pages are read whole;
tags and comments that never end hide the rest of the page. Only the three named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Set
from hashlib import blake2b
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from uidloom.sources.session import materialize

_BLOCKS = pa.list_(pa.struct([
    ("text", pa.string()), ("around", pa.list_(pa.int64())), ("main", pa.bool_()), ("article", pa.int32()), ("title", pa.bool_()),
    ("heading", pa.bool_()),
]))

LEAST_PAGES = 5
LEAST_SHARE = 0.2
MANY_PAGES = 50

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[A-Za-z!?/][^>]*\Z""",
    re.S,
)
_ATTRIBUTES = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HAS_NAMES = re.compile(r"(?:class|id|role)\s*=", re.I)
_RAW = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noscript")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
_DROPPED_TAGS = frozenset(
    "head script style noscript template svg math nav footer aside form button select textarea iframe object "
    "canvas audio video dialog title menu".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
_DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent notice newsletter subscribe popup modal overlay "
    "share sharing social comment comments disqus related recommended widget toolbar pagination pager".split()
)
#: Names of what stands beside the content only, never around it.
_NEVER_AROUND = frozenset("comment comments disqus cookie cookies consent".split())
#: A name after one of these says what stands beside an element or what it is about, not what it is.
_BESIDE = frozenset("has no not with without hide category tag".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_PLAIN = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption blockquote pre a abbr b bdi bdo cite code data del dfn em "
    "font i ins kbd label mark q s samp small span strong sub sup time tt u var".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_FENCES = frozenset("ul ol dl table select article main body".split())


class _Element:
    __slots__ = (
        "tag", "dropped", "content", "outer", "weak", "main", "article", "depth", "names", "parts", "shapes", "hash", "counts"
    )

    def __init__(self, tag: str, dropped: bool, content: str, outer: tuple[str, ...] = (), weak: tuple[str, ...] = ()):
        self.tag, self.dropped, self.content = tag, dropped, content
        self.outer, self.weak = outer, weak  # compound names around the content, and from the content on
        self.main, self.article = False, 0  # whether it is in main, and in which outer article of the page
        self.depth = 0  # elements of the stack up to the article or main it is in
        self.names = ""
        self.parts: list[str] = []
        self.shapes: list[str] = []
        self.hash = 0
        self.counts = False


class Block(NamedTuple):
    """A text, the subtrees whose deletion would delete it, and its place: in main, in which article, in a main title, in
    any heading."""

    text: str
    around: list[int]
    main: bool
    article: int
    title: bool
    heading: bool = False


def _has_body(blocks: list[Block]) -> bool:
    """Whether there is text besides headings."""
    return any(not b.heading for b in blocks)


def chosen(blocks: list[Block], often: Set[int] = frozenset(), pooled: Set[int] = frozenset()) -> list[Block]:
    """The blocks to keep, in page order, once the recurring subtrees are gone.

    If nothing but headings would be left of the marked content, the page has copies, and its content is no template.
    Outside marked content this holds for the ``pooled`` subtrees only. How long a template is does not matter.
    """
    if often or pooled:
        marked = [b for b in blocks if b.main or b.article]
        free = [b for b in blocks if not (b.main or b.article)]
        stay = [b for b in marked if often.isdisjoint(b.around) and pooled.isdisjoint(b.around)]
        free = [b for b in free if often.isdisjoint(b.around)]
        free_stay = [b for b in free if pooled.isdisjoint(b.around)]
        keep = {id(b) for b in (stay if _has_body(stay) else marked)}
        keep |= {id(b) for b in (free_stay if _has_body(free_stay) or marked else free)}
        blocks = [b for b in blocks if id(b) in keep]
    if any(b.main for b in blocks):
        blocks = [b for b in blocks if b.main or b.article]
    of_article: Counter[int] = Counter()
    for b in blocks:
        of_article[b.article] += len(b.text)
    articles = {article: n for article, n in of_article.items() if article}
    # A page's only article is its content. Several, or one inside main, may be teasers of other pages.
    only = len(articles) == 1 and not any(b.main for b in blocks)
    if only or 2 * max(articles.values(), default=0) > sum(of_article.values()):
        return [b for b in blocks if b.article or b.title]
    return blocks


def _judge(tag: str, attributes: str, content: str) -> tuple[bool, tuple[str, ...]]:
    """Whether tag, role or a whole class or id drop an element, and its compound names that hold a dropped name."""
    if tag in _DROPPED_TAGS or tag == "header" and not content:
        return True, ()
    weak: list[str] = []
    if attributes and tag not in ("html", "body") and _HAS_NAMES.search(attributes):
        named = tag != "main" and (tag != "article" or content == "article")
        for name, *values in _ATTRIBUTES.findall(attributes):
            name = name.lower()
            if name == "role":
                words = re.split(r"[\s_-]+", "".join(values).lower())
                if not _DROPPED_ROLES.isdisjoint(words) or "header" in words and not content:
                    return True, ()
            elif named and name in ("class", "id"):
                for compound in "".join(values).lower().split():
                    words = re.split(r"[_-]+", compound)
                    for before, word in zip(("", *words), words):
                        if word in _DROPPED_NAMES or word == "header" and not content:
                            if len(words) == 1:
                                return True, ()
                            if before not in _BESIDE:
                                weak.append(compound)
                                break
    return False, tuple(weak)


def _names(attributes: str) -> str:
    """Class, id and role without digits, as these often number the page."""
    found = [(name.lower(), "".join(values)) for name, *values in _ATTRIBUTES.findall(attributes)]
    return " ".join(f"{name}={re.sub('[0-9]+', '', value)}" for name, value in found if name in ("class", "id", "role"))


def _hash(tag: str, names: str, parts: list[str]) -> int:
    inside = f"{tag}\0{names}\0" + "\0".join(parts)
    return int.from_bytes(blake2b(inside.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) or 1


class Page:
    """Blocks of kept text with the elements around them, and the counted subtrees with their shapes, 0 for plain ones.

    Of elements that rules drop only the outermost count; what they hold goes with them.
    """

    def __init__(self, page: str):
        self.blocks: list[tuple[str, _Element, list[_Element], bool, bool]] = []
        self.subtrees: dict[int, int] = {}
        self._articles = 0
        self._stack: list[_Element] = [_Element("", False, "")]
        self._text: list[str] = []
        at, end = 0, len(page)
        while at < end:
            token = _TOKEN.search(page, at)
            stop = token.start() if token else end
            if stop > at:
                self._add_text(page[at:stop])
            if not token:
                break
            at = token.end()
            closing, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
                continue
            self._open(tag, attributes)
            if tag in _RAW:
                raw_end = _RAW[tag].search(page, at)
                at = raw_end.start() if raw_end else end
        self._flush()
        while len(self._stack) > 1:
            self._pop()

    def _add_text(self, raw: str) -> None:
        top = self._stack[-1]
        top.parts.append(" ".join(raw.split()))
        if not top.dropped:
            self._text.append(entities.unescape(raw) if "&" in raw else raw)

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text.clear()
            if text:
                top = self._stack[-1]
                headings = {e.tag for e in self._stack} & _HEADINGS
                title = top.main and not top.article and "h1" in headings
                self.blocks.append((text, top, self._stack[max(top.depth, 1):], title, bool(headings)))

    def _open(self, tag: str, attributes: str) -> None:
        if tag in _BLOCK:
            self._flush()
            self._close_implied(tag)
        elif tag == "br":
            self._text.append(" ")
        if tag in _VOID:
            return
        top = self._stack[-1]
        dropped, names = (True, ()) if top.dropped else _judge(tag, attributes, top.content)
        content, outer, weak = top.content, top.outer, top.weak + names
        if not dropped and (tag == "article" or tag == "main" and not content):
            if content != "article":
                outer, weak = outer + weak if tag == "article" else (), ()
            content = tag
        element = _Element(tag, dropped, content, outer, weak)
        element.main, element.article = top.main or content == "main", top.article
        if content == "article" and not top.article:
            self._articles += 1
            element.article = self._articles
        element.depth = len(self._stack) + 1 if element.article != top.article or element.main != top.main else top.depth
        if attributes and _HAS_NAMES.search(attributes):
            element.names = _names(attributes)
        self._stack.append(element)

    def _close_implied(self, tag: str) -> None:
        closes = _CLOSES.get(tag, ())
        for k in range(len(self._stack) - 1, 0, -1):
            name = self._stack[k].tag
            if name == "p" or name in closes:
                while len(self._stack) > k:
                    self._pop()
                closes = closes if name == "p" else ()
            elif name in _FENCES or name in _BLOCK and not closes:
                return

    def _close(self, tag: str) -> None:
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k].tag == tag:
                if any(e.tag in _BLOCK for e in self._stack[k:]):
                    self._flush()
                while len(self._stack) > k:
                    self._pop()
                return

    def _pop(self) -> None:
        element = self._stack.pop()
        if element.content and element.tag in ("article", "main"):
            return
        if element.tag in ("html", "body", "head"):
            return
        above = self._stack[-1]
        element.hash = _hash(element.tag, element.names, element.parts)
        shape = _hash(element.tag, element.names, element.shapes)
        above.parts.append(f"<{element.hash}>")
        if not above.shapes or above.shapes[-1] != f"{shape}":
            above.shapes.append(f"{shape}")
        plain = not element.names and (element.tag in _PLAIN or not element.shapes)
        element.counts = not above.dropped and not (element.content and not element.names and element.tag in _PLAIN)
        if element.counts:
            self.subtrees[element.hash] = 0 if plain and not element.dropped else shape

    def _without_named(self) -> list[tuple]:
        """Blocks without those that a compound class or id drops.

        Names on elements around marked content drop what stands beside it in them, and whole articles only if others
        are left. Names inside marked content, or of a page without, drop their elements, whatever their length; but a
        name without which only headings would be left belongs to a wrapper of the content and drops nothing, unless it
        speaks of what readers write or are asked to accept. On pages that mark no content nothing but its share of the
        text tells a wrapper: there a name around more than half of it drops nothing either.
        """
        if not any(top.outer or top.weak for _, top, *_ in self.blocks):
            return self.blocks
        left, marked = self.blocks, any(top.content for _, top, *_ in self.blocks)
        whole = sum(len(text) for text, *_ in left)
        for name in dict.fromkeys(n for _, top, *_ in self.blocks for n in top.weak):
            without = [b for b in left if name not in b[1].weak]
            beside = any(not heading for *_, heading in without)
            if not marked:
                beside = 2 * sum(len(text) for text, *_ in without) >= whole
            if beside or not _NEVER_AROUND.isdisjoint(re.split(r"[_-]+", name)):
                left = without
        free = [b for b in left if not b[1].outer]
        return free if any(top.content for _, top, *_ in free) else [b for b in left if b[1].content or not b[1].outer]

    def found(self) -> list[Block]:
        """Blocks in page order without those that tags, roles, classes and ids drop."""
        return [
            Block(text, [e.hash for e in around if e.counts], top.main, top.article, title, heading)
            for text, top, around, title, heading in self._without_named()
        ]

    def kept(self) -> list[tuple[str, list[int]]]:
        """Texts to keep if no subtree is deleted, each with the subtrees whose deletion would delete it."""
        return [(b.text, b.around) for b in chosen(self.found())]


def host_of(url: str | None) -> str | None:
    try:
        return (urlsplit(url).hostname or None) if url else None
    except ValueError:
        return None


def subtree_counts(pages: DataFrame) -> DataFrame:
    """(host, key, subtree, shape, first) of every page with a host; subtree 0 stands for the page itself.

    ``first`` marks one subtree of each shape of a page.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, subtrees, shapes, first = [], [], [], [], []
            for key, url, page in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "html"))):
                host = host_of(url)
                if host is not None:
                    found = [(0, 0), *sorted(Page(page or "").subtrees.items())]
                    hosts += [host] * len(found)
                    keys += [key] * len(found)
                    seen: set[int] = set()
                    for subtree, shape in found:
                        subtrees.append(subtree)
                        shapes.append(shape)
                        first.append(shape not in seen)
                        seen.add(shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (keys, subtrees, shapes)), pa.array(first, pa.bool_())],
                names=["host", "key", "subtree", "shape", "first"],
            )

    return pages.mapInArrow(parse, "host string, key bigint, subtree bigint, shape bigint, first boolean")


def templates_of(
    found: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, many_pages: int = MANY_PAGES
) -> DataFrame:
    """(host, subtree, often) of the templates; ``often`` if the share of the pages alone makes it one."""
    counts = found.groupBy("host", "shape", "subtree").agg(
        F.count("*").alias("n"), F.sum(F.col("first").cast("bigint")).alias("n_first")
    )
    hosts = counts.where("subtree = 0").select("host", "n").withColumnRenamed("n", "of_host")
    least = F.greatest(F.lit(least_pages), F.col("of_host") * least_share)
    shapes = (
        counts.where("shape <> 0").groupBy("host", "shape").agg(F.sum("n_first").alias("pages"), F.count("*").alias("texts"))
        .where(F.col("pages") >= F.col("texts") * least_pages)
        .join(hosts, "host").where(F.col("pages") >= least)
        .select("host", "shape", F.lit(True).alias("pooled"))
    )
    again = counts.where("subtree <> 0").where(F.col("n") >= min(2, least_pages))
    return (
        again.join(hosts, "host").join(shapes, ["host", "shape"], "left")
        .withColumn("often", F.col("n") >= least)
        .where(F.col("often") | F.col("pooled") | (F.col("shape") != 0) & (F.col("n") >= many_pages))
        .select("host", "subtree", "often")
    )


def extract(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, many_pages: int = MANY_PAGES
) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html) its main text.

    A subtree is a template if at least ``least_pages`` pages and ``least_share`` of the pages of its host hold it, or
    ``many_pages`` pages however large the host is. It is one as well if it recurs and its shape is on that share of
    the pages with few texts, each on ``least_pages`` pages on average, as menus and adverts that take turns are.
    """
    pages = pages.select(
        "page_id", "url", "html", F.xxhash64("page_id", "url", F.coalesce("html", F.lit(""))).alias("key")
    )
    found = materialize(subtree_counts(pages), "subtrees")
    templates = templates_of(found, least_pages, least_share, many_pages)
    deleted = (
        found.select("host", "key", "subtree").join(templates, ["host", "subtree"]).groupBy("key").agg(
            F.collect_set(F.when(F.col("often"), F.col("subtree"))).alias("often"),
            F.collect_set(F.when(~F.col("often"), F.col("subtree"))).alias("pooled"),
        )
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = []
            for page in batch.column(3).to_pylist():
                found = Page(page or "").found()
                if not any(b.around for b in found):  # no deletion can change the choice
                    found = [Block("\n".join(b.text for b in chosen(found)), [], False, 0, False, False)]
                blocks.append([b._asdict() for b in found])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(blocks, _BLOCKS)], names=["page_id", "url", "key", "blocks"]
            )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for blocks, often, pooled in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                left = chosen([Block(**b) for b in blocks], frozenset(often or ()), frozenset(pooled or ()))
                texts.append("\n".join(b.text for b in left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    block = "struct<text string, around array<bigint>, main boolean, article int, title boolean, heading boolean>"
    parsed = pages.select("page_id", "url", "key", "html").mapInArrow(
        parse, f"page_id bigint, url string, key bigint, blocks array<{block}>"
    )
    joined = parsed.join(deleted, "key", "left").select("page_id", "url", "blocks", "often", "pooled")
    return joined.mapInArrow(choose, "page_id bigint, url string, text string, n_chars bigint")
