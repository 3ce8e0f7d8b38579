"""Main text of web pages, with site templates found by counting subtrees per host.

Every element that can be page furniture (``CONTAINERS``; outside an article
also paragraphs) is hashed over its whole subtree: tags, structure and text.
Spark counts on how many different pages of a host each subtree stands.  One
that recurs on at least ``LEAST_PAGES`` pages and ``LEAST_SHARE`` of the host's
pages is template.  A large host shows many variants of its template, none of
them on such a share: an element that is no text of its own (``Node.counted``)
is template as soon as it stands beside ``LEAST_PAGES`` different texts, however
many pages the host has.  Both are deleted wherever the host shows them.  What
differs from page to page (adverts, footers with a date) the counts cannot see:
elements that say by their tag, role or class that they are no article go by that.

The article is what stands in ``article`` elements; in ``main`` with the
articles in it, if there are none or main's own text is more than all of them or
than the longest; in the body, if there is neither or the articles are less than a
quarter of the page's paragraphs (teasers beside a story).  An article's own
paragraphs are never taken for template, however often a site repeats them; a
whole article is if main's own text beside it is longer.
"""

from __future__ import annotations

import hashlib
import html
import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import stored
from tallyframe.llm.url_filter import host_and_path

LEAST_PAGES, LEAST_SHARE = 5, 0.3
#: Template hashes (8 bytes each, and a host) that are sent to all tasks; more are joined by a shuffle.
MOST_BROADCAST_HASHES = 200_000
#: Hashes found by count alone that go along with each page of a host; if a host has more, each page gets its own only.
MOST_OF_HOST = 2_000
#: Pages whose longest block has so many characters and is the same are one text; counts alone leave a page at least one part in LEAST_LEFT.
LONG_BLOCK, LEAST_LEFT = 200, 10
#: Salts of the join of page and subtree, where one subtree may stand on many pages of a host.
SALTS = 32

# Element and class names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
DROPPED = set("script style textarea title xmp iframe noembed noframes head noscript template nav footer aside form button select dialog menu svg canvas object audio video datalist".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul""".split())
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption dt dd tr".split())
CONTAINERS = BLOCKS - PARAGRAPHS - {"html", "body", "main", "article"}
LISTS = set("ul ol dl dir menu table thead tbody tfoot figure".split())
SPACES = {"br", "td", "th", "img", "option"}
CLOSES_ITSELF = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "option": {"select"}}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
FURNITURE = set("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo
promoted recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
#: Other parts of a class name that is furniture as a whole.
HOLDERS = set("box boxes button buttons link links list slot unit".split())
#: Elements that are no shell around a page; an article in one counts only if the page has none elsewhere.
ASIDES = DROPPED - {"head", "form"}
#: Elements beyond which a start tag closes nothing.
HOLD_OPEN = set("div section article main body table blockquote li form".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|(<)(?=/?[a-zA-Z])""", re.S)
_MARK = re.compile(r"<(?:[!?]|/?([a-zA-Z]))")
_NAME_END = re.compile(r"[\s/>]")
_EVENTS = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass(slots=True)
class Node:
    tag: str
    dropped: bool
    zone: int  # 0 outside main and article, 1 in main, 2 in an article
    parent: Node | None
    article: Node | None = None  # the outermost one it is or stands in
    furniture: bool = False  # by its own tag or attributes, whatever it stands in
    start: int = 0  # number of its start tag
    depth: int = 0
    above: Node | None = None  # the nearest furniture it stands in
    aside: bool = False  # it is, or stands in, furniture that is no shell around a page
    holds: bool = False  # paragraphs
    digest: object = field(default_factory=lambda: hashlib.blake2b(digest_size=8))
    key: int | None = None

    def counted(self) -> bool:
        """Whether a number of pages alone makes it template: no list item, and in an article no list, table or holder of paragraphs."""
        return self.tag in CONTAINERS - {"li"} and (self.zone < 2 or self.tag not in LISTS and not self.holds)

    def close(self) -> None:
        self.key = int.from_bytes(self.digest.digest(), "little", signed=True)
        if self.parent:
            self.parent.digest.update(f"<{self.tag} {self.key}>".encode())


def _is_furniture(tag: str, attributes: str, zone: int) -> bool:
    if tag in DROPPED or tag == "header" and zone < 2:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape("".join(values)).lower()
        if name in ("class", "id"):
            if tag == "header":  # in an article: its title
                continue
            words = {"comment", "comments"} if tag == "article" else FURNITURE - {"header"} if zone == 2 else FURNITURE
            for token in value.split():
                parts = set(_NAME_PARTS.split(token)) - {""}
                if parts & words and parts <= words | HOLDERS:
                    return True
        elif name == "role" and value in ROLES or name == "hidden" and tag != "article" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


class Markup:
    """Tags and comments of a source from the first ``<`` on whose tag never ends; such a ``<`` is text.

    One pass backwards tells of every ``>`` and quotation mark whether a tag
    that comes to it ends, so that no ``<`` is followed to the end of the page
    in vain.
    """

    def __init__(self, source: str, at: int):
        self.source, self.name_end = source, 0
        self._look_ahead(at)

    def after(self, at: int) -> re.Match | None:
        while mark := _MARK.search(self.source, at):
            if not mark[1] or self._ends(mark.end()):
                return _TOKEN.match(self.source, mark.start())
            at = mark.start() + 1
        return None

    def _look_ahead(self, at: int) -> None:
        self.events = array("q", (m.start() for m in _EVENTS.finditer(self.source, at)))
        self.ending = bytearray(len(self.events) + 1)
        quotes = {'"': len(self.events), "'": len(self.events)}  # the next of each
        for i in range(len(self.events) - 1, -1, -1):
            if (mark := self.source[self.events[i]]) == ">":
                self.ending[i] = 1
            else:
                self.ending[i] = self.ending[min(quotes[mark] + 1, len(self.events))]
                quotes[mark] = i

    def _ends(self, name: int) -> bool:
        """Whether a tag whose name goes on here ends."""
        if self.name_end < name:
            found = _NAME_END.search(self.source, name)
            self.name_end = found.start() if found else len(self.source)
        return bool(self.ending[bisect_left(self.events, self.name_end)])


class Page:
    """Blocks of a page with the elements around them; tolerant of unclosed and stray tags."""

    def __init__(self, source: str, spared: set[int] = frozenset()):
        self.spared, self.starts = spared, 0
        self.blocks: list[tuple[str, Node]] = []
        self.nodes: list[Node] = []
        self.top = Node("", False, 0, None)
        self.open: dict[str, list[Node]] = defaultdict(list)
        self.parts: list[str] = []
        markup, at = None, 0
        while token := markup.after(at) if markup else _TOKEN.search(source, at):
            slash, tag, attributes, endless = token.groups()
            if endless:
                markup = Markup(source, token.start())
                continue
            self._text(source[at:token.start()])
            at = token.end()
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                self._end(tag)
            else:
                self._start(tag, attributes)
                if tag in RAW:  # no markup inside
                    stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
                    at = stop.end() if stop else len(source)
                    self._end(tag)
        self._text(source[at:])
        while self.top.parent:
            self._pop()
        self._flush()
        if not spared and (shells := self._shells()):
            self.__init__(source, shells)

    def _shells(self) -> set[int]:
        """Start tags of dropped elements that hold an article or main, which are no furniture."""
        shells, last, free = set(), set(), False
        for node in self.nodes:
            if node.tag in ("article", "main") and not node.furniture and node.parent.zone < 2:
                up = node.parent if node.parent.furniture else node.parent.above
                free |= up is None
                found = last if up and up.aside else shells
                while up and up.start not in found:  # what is there already, is there with all above it
                    found.add(up.start)
                    up = up.above
        return shells if shells or free else last

    def _text(self, raw: str) -> None:
        if raw and not self.top.dropped:
            self.parts.append(raw)
        elif raw:
            self.top.digest.update(raw.encode())

    def _flush(self) -> None:
        """End a block."""
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            self.parts = []
            if text:
                self.top.digest.update(text.encode())
                self.blocks.append((text, self.top))

    def _leave(self) -> None:
        self.top.close()
        self.open[self.top.tag].pop()
        self.top = self.top.parent

    def _pop(self) -> None:
        self._flush()
        self._leave()

    def _start(self, tag: str, attributes: str) -> None:
        self.starts += 1
        if tag in BLOCKS:
            self._flush()
            if self.open["p"]:
                self._close_open("p")
            if tag in CLOSES_ITSELF and self.open[tag]:
                self._close_open(tag)
        elif tag in SPACES and not self.top.dropped:
            self.parts.append(" ")
        if tag in VOID or tag not in BLOCKS and tag not in DROPPED and not _is_furniture(tag, attributes, self.top.zone):
            return  # markup inside a block
        zone = max(self.top.zone, {"main": 1, "article": 2}.get(tag, 0))
        furniture = self.starts not in self.spared and _is_furniture(tag, attributes, self.top.zone)
        dropped = self.top.dropped or furniture
        if dropped and not self.top.dropped:
            if tag in BLOCKS:
                self._flush()
            else:
                self.parts.append(" ")
        over = self.top
        self.top = Node(tag, dropped, zone, over, over.article, furniture, self.starts, over.depth + 1, over if over.furniture else over.above, over.aside or furniture and tag in ASIDES)
        self.open[tag].append(self.top)
        if tag == "article" and not self.top.article:
            self.top.article = self.top
        self.nodes.append(self.top)
        if tag in PARAGRAPHS:
            node = self.top.parent
            while node and not node.holds:
                node.holds, node = True, node.parent

    def _close_open(self, tag: str) -> None:
        """Close an open ``tag`` that the next start tag ends, unless an element that holds it stands between."""
        node = self.open[tag][-1]
        if self.top is not node:
            for t in HOLD_OPEN | CLOSES_ITSELF.get(tag, set()):
                if self.open[t] and self.open[t][-1].depth > node.depth:
                    return
            while self.top is not node:
                self._pop()
        self._pop()

    def _end(self, tag: str) -> None:
        if self.open[tag]:
            node = self.open[tag][-1]
            if tag in BLOCKS:
                self._flush()
            held = self.parts if tag not in BLOCKS else []
            while self.top is not node:
                self._pop()
            self._leave()
            self.parts = held
        elif tag in BLOCKS:
            self._flush()

    def _scope(self) -> list[tuple[str, Node]]:
        """Blocks of articles and main; all blocks if there are none, or if paragraphs outside are more than three times the articles' text."""
        blocks = [(t, n) for t, n in self.blocks if not n.dropped]
        inner = [(t, n) for t, n in blocks if n.zone]
        if not inner or all(n.zone == 2 for _, n in inner) and 3 * _length(inner) < sum(len(t) for t, n in blocks if not n.zone and n.tag in PARAGRAPHS):
            return blocks
        return inner

    def candidates(self) -> set[int]:
        """Hashes of the elements that can be template."""
        cards = self._cards()
        return {n.key for n in self.nodes if _can_be_template(n, cards)}

    def counted(self) -> set[int]:
        """Those of the candidates that a number of pages alone makes template."""
        cards = self._cards()
        return {n.key for n in self.nodes if _can_be_template(n, cards) and (n.counted() or n.tag == "article")}

    def _cards(self) -> set[int]:
        """Start tags of articles with less text than main has of its own."""
        blocks = self._scope()
        own = sum(len(t) for t, n in blocks if n.zone == 1)
        return {start for start, n in _article_lengths(blocks).items() if n < own}

    def story(self) -> int:
        """Hash by which pages with the same text are known: of the longest block if it is long, else of the whole text."""
        kept = self.text(set())
        longest = max(kept.split("\n\n"), key=len)
        return _hash(longest if len(longest) >= LONG_BLOCK else kept)

    def _inside(self, cards: set[int], templates: set[int], alone: bool = False) -> set[int]:
        """Start tags of the elements that are template or stand in it."""
        inside: set[int] = set()
        for n in self.nodes:  # each behind the one it stands in
            if n.parent.start in inside or n.key in templates and _can_be_template(n, cards) and (not alone or n.counted() or n.tag == "article"):
                inside.add(n.start)
        return inside

    def text(self, templates: set[int], recurring: set[int] = frozenset()) -> str:
        """Text without the host's ``templates`` and what recurs there by count alone."""
        scope, cards = self._scope(), self._cards() if templates or recurring else set()
        if templates:
            inside = self._inside(cards, templates)
            scope = [(t, n) for t, n in scope if n.start not in inside] or scope
        kept = _story(scope)
        if recurring:
            inside = self._inside(cards, recurring, alone=True)
            left = _story([(t, n) for t, n in scope if n.start not in inside])
            if LEAST_LEFT * _length(left) >= _length(kept):
                kept = left
        return "\n\n".join(t for t, _ in kept)


def _length(blocks: list[tuple[str, Node]]) -> int:
    return sum(len(t) for t, _ in blocks)


def _article_lengths(blocks: list[tuple[str, Node]]) -> dict[int, int]:
    out: dict[int, int] = {}
    for text, node in blocks:
        if node.article:
            out[node.article.start] = out.get(node.article.start, 0) + len(text)
    return out


def _story(blocks: list[tuple[str, Node]]) -> list[tuple[str, Node]]:
    """The articles only, if they hold most of the text and the longest is no teaser beside main's own."""
    articles = _article_lengths(blocks)
    own = sum(len(t) for t, n in blocks if n.zone == 1)
    if articles and all(n.zone for _, n in blocks) and own <= min(sum(articles.values()), max(articles.values())):
        return [(t, n) for t, n in blocks if n.zone == 2]
    return blocks


def _can_be_template(node: Node, cards: set[int]) -> bool:
    return node.tag in CONTAINERS or node.tag in PARAGRAPHS and node.zone < 2 or node is node.article and node.start in cards


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _subtrees(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``host, page, story, subtree`` of every candidate, and one row a page without subtree; the story only where a count alone may decide."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, page_keys, stories, subtrees = [], [], [], []
            for host, key, source in zip(*(c.to_pylist() for c in batch.columns)):
                page = Page(source or "")
                found, counted, story = [None, *page.candidates()], page.counted(), page.story()  # null stands for the page itself
                hosts += [host] * len(found)
                page_keys += [key] * len(found)
                stories += [story if k in counted else None for k in found]
                subtrees += found
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in (page_keys, stories, subtrees))], names=["host", "page", "story", "subtree"])

    return pages.select(host_and_path(F.col(url_col))[0].alias("host"), _page_key(html_col).alias("page"), html_col).mapInArrow(run, "host string, page long, story long, subtree long")


def _page_key(html_col: str):
    return F.xxhash64(F.coalesce(F.col(html_col), F.lit("")))


def recurring_subtrees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, subtree, by_share``: subtrees that recur across a host's pages, by their share of them or by count alone.

    Equal pages count once; for the count alone, so do pages with the same text.
    """
    found = _subtrees(pages, url_col, html_col)
    counts = found.groupBy("host", "subtree").agg(F.countDistinct("page").alias("pages"), F.countDistinct("story").alias("stories"))
    totals = counts.where("subtree is null").select(F.col("host").alias("of"), F.col("pages").alias("total"))
    often = counts.where(f"subtree is not null and pages >= {LEAST_PAGES}")
    return often.join(totals, often.host == totals.of).select(
        "host", "subtree", "stories", (F.col("pages") >= LEAST_SHARE * F.col("total")).alias("by_share")).where(f"by_share or stories >= {LEAST_PAGES}").drop("stories")


def _by_host(recurring: DataFrame, name: str) -> DataFrame:
    return recurring.groupBy("host").agg(F.collect_list("subtree").alias(name))


def _size(recurring: DataFrame) -> tuple[int, int]:
    """Hashes of all hosts (a host counts as eight more), and of the host that has most."""
    row = recurring.groupBy("host").count().agg(F.sum(F.col("count") + 8), F.max("count")).first()
    return row[0] or 0, row[1] or 0


def site_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, templates array<long>``: subtrees on a share of a host's pages.

    A host has at most (subtrees per page) / ``LEAST_SHARE`` of them, so its row
    is bounded however many pages it has.
    """
    return _by_host(recurring_subtrees(pages, url_col, html_col).where("by_share"), "templates")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id_col, url_col, text``.

    Blocks of the article in page order, joined by two line feeds; character
    references decoded, white space in a block turned into one space.  A null or
    empty page, and one without text, gives the empty text.  A null URL has the
    empty host.  Repeated rows come back as often as they stand there.
    """
    found = stored(recurring_subtrees(pages, url_col, html_col), "subtrees")
    shared, alone = found.where("by_share"), found.where("not by_share")
    size, _ = _size(shared)
    more, most = _size(alone)
    templates = _by_host(shared, "templates")
    narrow = pages.select(host_and_path(F.col(url_col))[0].alias("host"), _page_key(html_col).alias("key"), F.col(id_col).alias("page"), F.col(url_col).alias("address"), F.col(html_col).alias("source"))
    every_salt, salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))), F.expr(f"cast(pmod(key, {SALTS}) as int)")
    if size <= MOST_BROADCAST_HASHES:
        joined = narrow.join(F.broadcast(templates), "host", "left")
    else:
        joined = narrow.withColumn("salt", salt).join(templates.withColumn("salt", every_salt), ["host", "salt"], "left").drop("salt")
    if most <= MOST_OF_HOST and more <= MOST_BROADCAST_HASHES:
        joined = joined.join(F.broadcast(_by_host(alone, "recurring")), "host", "left")
    else:
        salted = alone.select("host", "subtree").withColumn("salt", every_salt)
        on_pages = _subtrees(pages, url_col, html_col).select("host", F.col("page").alias("key"), "subtree").distinct().withColumn("salt", salt)
        joined = joined.join(on_pages.join(salted, ["host", "subtree", "salt"]).groupBy("host", "key").agg(F.collect_list("subtree").alias("recurring")), ["host", "key"], "left")
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = [Page(source or "").text(set(keys or ()), set(more or ())) for source, keys, more in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=[id_col, url_col, "text"])

    return joined.select("page", "address", "source", "templates", "recurring").mapInArrow(run, f"`{id_col}` {id_type}, `{url_col}` string, text string")
