"""Main text of web pages by site template removal.

Every page is parsed into a list of elements and texts. The subtrees of block elements are
hashed, the hashes are counted per host in Spark, and subtrees that recur on many pages of
a host are deleted, together with what its element, role or class name marks as menu,
header, footer, sidebar, notice, advert, form or comment. Where a page names its article
or main part, only that is kept; inside it templates and marks are still deleted.

Pages count by a signature of their longest block: the least hash of its five-word
shingles, which near copies mostly share. A subtree is template where it stands on pages of
``least`` signatures and of ``share`` of the host's, so copies of an article are no evidence
of a template, however often they occur. Paragraphs, headings, lists and tables directly in
a named article are never template, wrappers around them may be. Inside a named article,
wrappers without prose also count by rows, with at least half of them. A host's templates
are at most the mean number of subtrees of a page divided by ``share``, so they travel as
one list. A subtree that holds all of a page's text is never deleted.

A class or id marks an element only if a whole name of it says so (``footer``,
``cookie-banner``), not a part of another (``no-comments``, ``social-science``). A marked
element that holds the main part stays, so does a form around it or around most of a page's
text, and marks by name that would leave nothing of a page are ignored.

Null and empty html give an empty text. A null or malformed url is one host of its own.
Unclosed and stray tags are mended as browsers do, in one pass, whatever the depth.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Collection, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.llm.common import byte_slices, named, stored

SHARE = 0.05
SHARE_OF_ROWS = 0.5
LEAST_PAGES = 5
SHINGLE = 5

# Names of the HTML standard, and class names in common use.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = set(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}}
SIBLINGS |= {"td": {"td", "th"}, "th": {"td", "th"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}}
LIMITS |= {"td": {"tr", "table"}, "th": {"tr", "table"}}
DROPPED = set(
    "head script style noscript template nav footer aside form button input select option textarea iframe svg canvas "
    "object embed applet map dialog menu audio video title".split()
)
DROPPED_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)
DROPPED_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars rail footer "
    "cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay newsletter subscribe "
    "subscription signup paywall social share sharing sharebar comment comments commentlist disqus reply replies "
    "respond discussion feedback related recommended recommendations pagination pager toolbar widget widgets login "
    "search searchform skiplink copyright".split()
)
DROPPED_ARTICLES = {"comment", "comments", "reply", "ad", "advert", "sponsored", "related"}
# Site headers; inside a main part a header is the article's own.
HEADER_NAMES = set("header masthead topbar siteheader".split())
# Words that a compound name may hold beside one of the above.
POSITION_NAMES = set(
    "site main top bottom left right page global primary secondary mobile desktop sticky fixed floating bar box banner "
    "container wrapper wrap inner outer section area list block panel links items item post posts article articles "
    "stories form buttons button icons message body thread content row column col holder region module slot unit zone".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre figure table dl ul ol".split())
NAME = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")
OPEN, TEXT, CLOSE = 0, 1, 2
# How an element is marked: not, by element or role, by its name, as a form.
FREE, MARKED, NAMED, FORM = 0, 1, 2, 3


class Page(HTMLParser):
    """A page as a flat list of (kind, name or text, dropped, main) in page order. ``end``
    gives for each opened element the place behind its subtree, ``hash`` the hash of its
    name, texts (with plain white space) and subtrees."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[int, str, int, bool]] = []
        self.settled: list[tuple[int, str, int, bool]] = []
        self.end: dict[int, int] = {}
        self.hash: dict[int, int] = {}
        self.stack: list[tuple[str, int, list[bytes]]] = []
        self.mains = 0

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "td", "th", "li", "div", "article", "section", "main", "body", "button"})
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], LIMITS[tag])
        given = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        dropped, main = _marked(tag, tuple(sorted(given.items())), self.mains > 0)
        at = len(self.items)
        self.items.append((OPEN, tag, dropped, main))
        if tag in VOID:
            self.end[at] = at + 1
        else:
            self.stack.append((tag, at, [tag.encode()]))
            self.mains += tag in ("article", "main")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            return  # browsers ignore the slash
        if tag not in VOID:
            self._pop()

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if tag in INLINE and name not in INLINE:
                return  # an inline end tag does not close blocks

    def handle_data(self, data):
        self.items.append((TEXT, data, False, False))
        plain = " ".join(data.split())
        if plain and self.stack:
            self.stack[-1][2].append(xxhash.xxh64_digest(plain.encode("utf-8", "replace")))

    def _close(self, names: set[str], limits: set[str]) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name in names:
                while len(self.stack) > depth:
                    self._pop()
                return
            if name in limits:
                return

    def _pop(self) -> None:
        tag, at, parts = self.stack.pop()
        self.mains -= tag in ("article", "main")
        self.items.append((CLOSE, tag, False, False))
        self.end[at] = len(self.items)
        digest = xxhash.xxh64_digest(b"\0".join(parts))
        self.hash[at] = int.from_bytes(digest, signed=True)
        if self.stack:
            self.stack[-1][2].append(digest)

    def finish(self, html: str) -> Page:
        self.feed(html)
        self.close()
        while self.stack:
            self._pop()
        self._settle(NAMED, FORM)
        if not _text(self) and any(mark == NAMED for _, _, mark, _ in self.items):
            self._settle(FORM)
        self.items = [(kind, value, bool(mark), main) for kind, value, mark, main in self.settled]
        return self

    def _settle(self, *heeded: int) -> None:
        """Drops marks by name, or of forms, that hold the main part; marks that are not
        heeded; and those of forms that hold most of the text."""
        mains, texts, hidden = [0], [0], 0
        for at, (kind, value, mark, main) in enumerate(self.items):
            if kind == OPEN and mark == MARKED:
                hidden = max(hidden, self.end[at])
            seen = kind == TEXT and at >= hidden
            mains.append(mains[-1] + (kind == OPEN and main and not mark))
            texts.append(texts[-1] + (len(value.strip()) if seen else 0))
        self.settled = []
        for at, (kind, value, mark, main) in enumerate(self.items):
            if mark in (NAMED, FORM):
                end = self.end[at]
                most = mark == FORM and 2 * (texts[end] - texts[at]) > texts[-1] and not mains[-1]
                if mark not in heeded or mains[end] > mains[at + 1] or most:
                    mark = FREE
            self.settled.append((kind, value, mark, main))


def _names_in(value: str, known: Collection[str]) -> bool:
    """Whether a name of the list is a whole word of the value, or a compound of such
    names and words for places only."""
    for word in value.split():
        parts = [p.lower() for p in NAME.findall(word)]
        if "".join(parts) in known:
            return True
        if any(p in known for p in parts) and all(p in known or p in POSITION_NAMES for p in parts):
            return True
    return False


@lru_cache(maxsize=4096)
def _marked(tag: str, attrs: tuple[tuple[str, str], ...], in_main: bool) -> tuple[int, bool]:
    """How an element is marked as no main text, and whether it is a main part."""
    given = dict(attrs)
    if "hidden" in given or given.get("aria-hidden") == "true":
        return MARKED, False
    if tag == "form":
        return FORM, False
    if tag in DROPPED:
        return MARKED, False
    if tag in ("html", "body"):
        return FREE, False
    role = given.get("role", "").lower()
    if role in DROPPED_ROLES or tag == "header" and not in_main:
        return MARKED, False
    value = given.get("class", "") + " " + given.get("id", "")
    if tag in ("article", "main") and not in_main:
        return (MARKED if _names_in(value, DROPPED_ARTICLES) else FREE), True
    marked = _names_in(value, DROPPED_NAMES) or not in_main and _names_in(value, HEADER_NAMES)
    return (NAMED if marked else FREE), role == "main"


def parsed(html: str) -> Page:
    return Page().finish(html)


def _main_parts(page: Page) -> list[tuple[int, int]]:
    """Outermost named main parts that are not dropped."""
    parts, at = [], 0
    while at < len(page.settled):
        kind, _, dropped, main = page.settled[at]
        if kind == OPEN and (dropped or main):
            if main and not dropped:
                parts.append((at, page.end[at]))
            at = page.end[at]
        else:
            at += 1
    return parts


def subtrees(page: Page) -> dict[int, int]:
    """Hashes by place of the block subtrees with text that may be template: in named main
    parts those that are no prose and not inside prose, elsewhere all without a main part."""
    parts = _main_parts(page)
    found, text_before = {}, [0]
    for kind, value, _, _ in page.items:
        text_before.append(text_before[-1] + (kind == TEXT and bool(value.strip())))
    part_starts = [a for a, _ in parts]
    prose_until = 0
    for at, (kind, tag, _, _) in enumerate(page.items):
        if kind != OPEN or tag in VOID or tag in ("html", "body", "head", "script", "style"):
            continue
        end, later = page.end[at], bisect_left(part_starts, at)
        if later < len(parts) and part_starts[later] < end:
            continue
        inside = later > 0 and at < parts[later - 1][1]
        if inside and (at < prose_until or tag in PROSE):
            prose_until = max(prose_until, end)
            continue
        if tag not in INLINE and text_before[end] > text_before[at]:
            found[at] = page.hash[at]
    return found


def without_prose(page: Page, at: int) -> bool:
    return not any(kind == OPEN and tag in PROSE for kind, tag, _, _ in page.items[at : page.end[at]])


def signature(page: Page) -> int:
    """The least hash of the shingles of the page's longest block that is not marked."""
    longest, block = "", []
    for start, stop in _main_parts(page) or [(0, len(page.items))]:
        at = start
        while at < stop:
            kind, value, dropped, _ = page.items[at]
            if kind == TEXT:
                block.append(value)
            elif value not in INLINE or dropped:
                if sum(map(len, block)) > len(longest):
                    longest = "".join(block)
                block = []
            at = page.end[at] if kind == OPEN and dropped else at + 1
        if sum(map(len, block)) > len(longest):
            longest = "".join(block)
        block = []
    words = longest.encode("utf-8", "replace").split()
    shingles = (b" ".join(words[i : i + SHINGLE]) for i in range(max(len(words) - SHINGLE + 1, 1)))
    return min(xxhash.xxh64_intdigest(s) for s in shingles) - (1 << 63)


def _text(page: Page, deleted: Collection[int] = ()) -> str:
    """The page's main text without marked elements and the given subtrees."""
    out: list[str] = []
    items = page.settled
    for start, stop in _main_parts(page) or [(0, len(items))]:
        at = start
        while at < stop:
            kind, value, dropped, _ = items[at]
            if kind == OPEN and (dropped or at in deleted):
                out.append("" if value in INLINE else " ")
                at = page.end[at]
                continue
            if kind == TEXT:
                out.append(value)
            elif value not in INLINE:
                out.append(" ")
            at += 1
        out.append(" ")
    return " ".join("".join(out).split())


def _without_whole(page: Page, deleted: set[int]) -> set[int]:
    """The places less those whose subtree holds all main text that is not marked."""
    places = []
    for start, stop in _main_parts(page) or [(0, len(page.items))]:
        at = start
        while at < stop:
            kind, value, dropped, _ = page.items[at]
            if kind == OPEN and dropped:
                at = page.end[at]
                continue
            if kind == TEXT and value.strip():
                places.append(at)
            at += 1
    return {at for at in deleted if not places or places[0] < at or places[-1] >= page.end[at]}


def main_text(html: str | None, templates: set[int] = frozenset()) -> str:
    """The page's main text without the given templates."""
    if not html:
        return ""
    page = parsed(html)
    if not templates:
        return _text(page)
    return _text(page, _without_whole(page, {at for at, h in subtrees(page).items() if h in templates}))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The subtrees of each page beside the page's signature, once more without it if they
    are no prose inside a named main part, and the same for the page itself without subtree."""
    schema = pa.schema([("host", pa.string()), ("hash", pa.int64()), ("page", pa.int64())])
    for batch in batches:
        for part in byte_slices(batch, "html"):
            hosts, hashes, pages = [], [], []
            for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                page = parsed(html or "")
                parts, found = _main_parts(page), subtrees(page)
                every = [None, *set(found.values())]
                inside = [None, *{h for at, h in found.items() if _within(parts, at) and without_prose(page, at)}]
                hosts += [host] * (len(every) + len(inside))
                hashes += every + inside
                pages += [signature(page)] * len(every) + [None] * len(inside)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((hosts, hashes, pages), schema.types)], schema=schema)


def _within(parts: list[tuple[int, int]], at: int) -> bool:
    later = bisect_left(parts, (at,))
    return later > 0 and at < parts[later - 1][1]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, "html"):
            rows = zip(part.column("html").to_pylist(), part.column("templates").to_pylist())
            texts = [main_text(html, frozenset(some or ())) for html, some in rows]
            # a reference may name a lone surrogate, which is no text
            texts = [t.encode("utf-8", "replace").decode() for t in texts]
            columns = [part.column(c) for c in ("page_id", "url", "host")]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "text", "n_chars"])


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST_PAGES) -> DataFrame:
    """(host, templates): the hashes of the subtrees that recur on many pages of a host.
    Pages of one signature count once, but for what is no prose inside a named main part."""
    found = pages.select("host", "html").mapInArrow(_hashes, "host string, hash bigint, page bigint")
    found = found.groupBy("host", "hash", "page").agg(F.count("*").alias("n"))
    copies = F.max(F.when(F.col("page").isNull(), F.col("n")))
    counts = found.groupBy("host", "hash").agg(F.count("page").alias("n"), F.coalesce(copies, F.lit(0)).alias("n_inside"))
    enough = F.greatest("n", "n_inside") >= least
    counts = stored(counts.where(enough | F.col("hash").isNull()), "subtrees")
    hosts = counts.where("hash IS NULL").select("host", F.col("n").alias("pages"), F.col("n_inside").alias("rows"))
    recurs = (F.col("n") >= least) & (F.col("n") >= share * F.col("pages"))
    recurs_inside = (F.col("n_inside") >= least) & (F.col("n_inside") >= SHARE_OF_ROWS * F.col("rows"))
    found = counts.where("hash IS NOT NULL").join(hosts, "host").where(recurs | recurs_inside)
    return found.groupBy("host").agg(F.collect_list("hash").alias("templates"))


def extracted(
    pages: DataFrame,
    share: float = SHARE,
    least: int = LEAST_PAGES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per page: page_id, url, host, text and n_chars."""
    pages = pages.select(
        named(pages, id_col).cast("bigint").alias("page_id"),
        named(pages, url_col).alias("url"),
        named(pages, html_col).alias("html"),
        host_of(named(pages, url_col)).alias("host"),
    )
    found = stored(templates(pages, share, least), "templates")
    both = pages.join(found, "host", "left").select("page_id", "url", "host", "html", "templates")
    return both.mapInArrow(_texts, "page_id bigint, url string, host string, text string, n_chars bigint")
