"""Main text of web pages: page furniture by its markup, site templates by subtrees that recur on a host.

Every element's subtree is hashed (tags and text).  Spark counts, for every host and for every first path segment of it, on
how many pages with different main text a subtree occurs; a subtree found on a share of them, or at a fixed number of
different addresses however large the host, is part of the site's template and is deleted from all of them.  Copies of one
page count once, so a page that was saved a thousand times is no template.  Paragraphs and list items of an article are
content, unless nearly all of many pages have them; its headings and cells are never deleted as a template.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm import sketch
from statquarry.llm.arrays import map_slices, mix
from statquarry.llm.storage import saved
from statquarry.session import BROADCAST_ROWS, splittable_join

SLICE_BYTES = 1 << 22
SOME_PAGES = 500
SKETCH_CELLS = 1 << 27

# fixed values: element names of HTML
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noframes"}
FURNITURE = {
    "head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "input", "svg", "canvas", "object",
    "audio", "video", "map", "datalist", "fieldset",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTENT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "dd", "dt", "figcaption", "td", "th", "tr"}
PARAGRAPHS = {"p", "li", "blockquote", "pre", "dd", "figcaption"}
ROOTS = {"html", "body", "article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# fixed values: elements that a class name can make furniture; text elements, headings and inline elements it cannot
CONTAINERS = {"address", "center", "details", "dir", "div", "dl", "figure", "ol", "section", "table", "ul"}
# fixed values: words of class names that mark furniture
MARKS = {
    "ad", "adbox", "ads", "adsense", "adslot", "adunit", "advert", "advertisement", "advertisements", "adverts", "breadcrumb",
    "breadcrumbs", "comment", "commentlist", "comments", "cookie", "cookies", "disqus", "footer", "gdpr", "nav", "navbar",
    "navigation", "newsletter", "pager", "pagination", "paginator", "popup", "promo", "promos", "promoted", "share", "sharing",
    "sidebar", "sidebars", "signup", "sponsor", "sponsored", "sponsors", "subscribe",
}
# fixed values: words that mark furniture outside an article only, where id names count too
OUTER = {
    "alert", "banner", "consent", "header", "masthead", "menu", "modal", "replies", "respond", "responses", "toolbar", "widget", "widgets",
}
# fixed values: words that may stand beside them in one name, as in ad-box or left-sidebar
BESIDE = {
    "area", "banner", "bar", "block", "bottom", "box", "button", "buttons", "consent", "container", "form", "inner", "item",
    "icons", "left", "links", "list", "menu", "notice", "outer", "popup", "primary", "right", "secondary", "section", "site", "slot",
    "social", "thread", "top", "unit", "widget", "wrap", "wrapper",
}
# fixed values: adverts by name go whatever the element, but for headings
ADVERTS = {"ad", "adbox", "ads", "adsense", "adslot", "adunit", "advert", "advertisement", "advertisements", "adverts", "sponsored"}
# fixed values: words that mark a container whatever stands beside them, as in reader-comments, unless the name tells a state
ANYWHERE = {"advert", "advertisement", "advertisements", "adverts", "comment", "commentlist", "comments"}
STATES = {"has", "is", "js", "no", "show", "with", "without"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert"}

# attributes as HTML reads them: a quote opens a value only straight after "="; a value that is never closed is no value
_ATTRIBUTES = r"""(?>[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+|(?=>)))?+)*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})>|<[/a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*+)))?+""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names_furniture(value: str, marks: set[str]) -> bool:
    """Whether a whole name of a class or id value consists of words for furniture: ad-box does, ad-hoc doesn't."""
    for name in value.split():
        words = [word.lower() for word in _NAME.findall(name)]
        # social is ambiguous alone, but not beside links or buttons
        marked = not marks.isdisjoint(words) or "social" in words and len(words) > 1
        if marked and all(word in marks or word in BESIDE for word in words):
            return True
        if marks >= ANYWHERE and not ANYWHERE.isdisjoint(words) and words[0] not in STATES:
            return True
    return False


def _marked(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element's own attributes make it furniture; in an article no id does, and fewer class names do."""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            if name == "class" and tag not in HEADINGS and tag not in ROOTS and _names_furniture(value, ADVERTS):
                return True
            if tag in CONTAINERS and _names_furniture(value, MARKS | OUTER):
                if not in_article or name == "class" and _names_furniture(value, MARKS):
                    return True
        elif name == "role" and value.lower() in ROLES or name == "hidden":
            return True
        elif name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


# what it takes to be a template: a share or a fixed number of pages, a share (few words, which recur by chance), nearly all
# pages (paragraphs of an article)
LONG, SHORT, LINE = range(3)
KINDS = {LONG: "long_ones", SHORT: "short_ones", LINE: "lines"}
FEW_WORDS = 4


class Page:
    """Elements of a page in page order; text as (element, text) with breaks (None) between blocks."""

    def __init__(self, source: str):
        self.tag, self.parent, self.skip, self.hash, self.words = ["#"], [-1], [False], [0], [0]
        self.text: list[tuple[int, str] | None] = []
        # per element: inside an article, inside an article or main element, in a header and not in a heading of it
        self.article, self.within, self.header = [False], [False], [False]
        self._items: dict[int, list[str]] = {0: []}
        self._stack = [0]
        self._open: Counter[str] = Counter()  # open elements by name
        self._read(source)
        while self._stack:
            self._close()

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = _TOKEN.match(source, at)
            at = found.end()
            tag = found[2]
            if tag is None:
                piece = found[0]
                if piece[0] != "<" or piece == "<":
                    self._add(html.unescape(piece) if "&" in piece else piece)
                continue
            tag = tag.lower()
            if found[1]:
                self._end(tag)
                continue
            if tag in RAW:
                if not found[3].endswith("/"):
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = close.end() if close else end
                continue
            self._start(tag, found[3])

    def _add(self, text: str) -> None:
        self.text.append((self._stack[-1], text))
        words = text.split()
        if words:
            self._items[self._stack[-1]].append(" ".join(words))
            self.words[self._stack[-1]] += len(words)

    def _start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block or tag in ("br", "hr"):
            self.text.append(None)
        if tag in VOID:
            return
        furniture = tag in FURNITURE or bool(attributes) and _marked(tag, attributes, self._in_article())
        if block:
            self._implied(tag)
        elif not furniture:
            return  # inline elements only carry text
        inside, up = tag == "header" and self._in_article(), self._stack[-1]
        self.tag.append(tag)
        self.parent.append(up)
        self.article.append(self.article[up] or tag == "article")
        self.within.append(self.within[up] or tag in ("article", "main"))
        self.header.append(tag not in HEADINGS and (tag == "header" or self.header[up]))
        self._open[tag] += 1
        self.skip.append(not inside if tag == "header" else furniture)  # an article's own header holds its title
        self.hash.append(0)
        self.words.append(0)
        self._stack.append(len(self.tag) - 1)
        self._items[len(self.tag) - 1] = []

    def _in_article(self) -> bool:
        return self.article[self._stack[-1]]

    def _implied(self, tag: str) -> None:
        """End tags that a start tag implies: a block ends a paragraph, an item the item before it."""
        ends = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
                "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
        closes, limit = ends.get(tag, (set(), set()))
        if not self._open["p"] and not any(self._open[name] for name in closes):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[k]]
            if name == "p" or name in closes:
                while len(self._stack) > k:
                    self._close()
                return
            if name in limit or name in BLOCKS and not closes:
                return

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.text.append(None)
        if not self._open[tag]:
            return
        for k in range(len(self._stack) - 1, 0, -1):
            name = self.tag[self._stack[k]]
            if name == tag:
                while len(self._stack) > k:
                    self._close()
                return
            if name in BLOCKS and tag not in BLOCKS or name in ("article", "main") and tag not in ("body", "html"):
                return  # an end tag that belongs to nothing open here

    def _close(self) -> None:
        node = self._stack.pop()
        self._open[self.tag[node]] -= 1
        items = self._items.pop(node)
        if items:
            body = "\x01".join([self.tag[node], *items])
            self.hash[node] = xxhash.xxh64_intdigest(body.encode("utf-8", "surrogatepass")) - (1 << 63)
            if node:
                self._items[self.parent[node]].append(f"\x02{self.hash[node]}")
                self.words[self.parent[node]] += self.words[node]

    def _roots(self) -> list[bool]:
        """Which elements lie in the article; the main element or the whole page serves where there is none."""
        dropped = self._dropped(frozenset())
        for wanted in ("article", "main"):
            inside = [False] * len(self.tag)
            for k in range(1, len(self.tag)):
                inside[k] = inside[self.parent[k]] or self.tag[k] == wanted and not dropped[k]
            if any(inside):
                return inside
        return [True] * len(self.tag)

    def _dropped(self, templates: frozenset) -> list[bool]:
        """``templates`` has subtrees of the kind ``LINE`` as the complement of their hash."""
        out = [False] * len(self.tag)
        for k in range(1, len(self.tag)):
            up = self.parent[k]
            out[k] = out[up] or self.skip[k] or bool(templates) and self._is_template(k, templates)
        return out

    def _is_template(self, node: int, templates: frozenset) -> bool:
        h = self.hash[node]
        if h in templates:
            return self._kind(node) in (LONG, SHORT)
        return ~h in templates and self._kind(node) == LINE

    def _kind(self, node: int) -> int | None:
        """Of what kind of template an element can be; not the article itself, nor headings and cells inside it."""
        tag = self.tag[node]
        if tag in ("html", "body", "article", "main"):
            return None
        usual = SHORT if self.words[node] < FEW_WORDS else LONG
        if tag not in CONTENT:
            return usual
        if not self.within[node]:
            return usual
        return LINE if tag in PARAGRAPHS else None

    def removable(self) -> list[tuple[int, int]]:
        """Hashes of the subtrees that may be templates, and their kinds."""
        found = {(h, self._kind(k)) for k, h in enumerate(self.hash) if k and h}
        return sorted((h, kind) for h, kind in found if kind is not None)

    def main_text(self, templates: frozenset = frozenset()) -> str:
        inside, dropped = self._roots(), self._dropped(templates)
        blocks, now = [], []
        # in an article's own header only headings are content
        for entry in [*self.text, None]:
            if entry is None:
                words = "".join(now).split()
                if words:
                    blocks.append(" ".join(words))
                now = []
            elif inside[entry[0]] and not dropped[entry[0]] and not self.header[entry[0]]:
                now.append(entry[1])
        return " ".join(blocks)


def _pages(pages: DataFrame, id: str, url: str, source: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    address = F.col(f"`{url}`").cast("string")
    host = F.lower(F.coalesce(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    section = F.coalesce(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1), F.lit(""))
    return pages.select(
        F.col(f"`{id}`").cast("long").alias("page_id"), address.alias("url"), body.alias("html"), host.alias("host"),
        section.alias("section"), F.xxhash64(host).alias("place"), F.xxhash64(F.regexp_extract(address, "^[^#]*", 0)).alias("address"),
        F.xxhash64(body, host, section).alias("key"),
    )


def _listed(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all subtrees of some pages: page, hash and kind, and a value for the hash on its host."""
    columns = [part.column(name) for name in KINDS.values()]
    sizes = [pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in columns]
    page = np.concatenate([np.repeat(np.arange(part.num_rows), n) for n in sizes])
    subtree = np.concatenate([c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in columns])
    kind = np.repeat(np.array(list(KINDS), np.int32), [int(n.sum()) for n in sizes])
    place = part.column("place").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return page, subtree, kind, mix(place)[page] ^ subtree.view(np.uint64)


def _repeated(found: DataFrame) -> DataFrame:
    """Written table of the pages' subtrees but for those that a sketch shows to be on one page of their host only."""
    total = found.select(sum(F.coalesce(F.sum(F.size(name)), F.lit(0)) for name in KINDS.values())).first()[0]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SOME_PAGES):
                yield batch.slice(low, SOME_PAGES)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part in parts(batches):
            yield _listed(part)[3]

    bits = sketch.sketch_bits(total, 8, SKETCH_CELLS)
    merged = sketch.build(found.select("place", *KINDS.values()), values, "twice", 2, bits)
    shared = found.sparkSession.sparkContext.broadcast(merged)  # depth * SKETCH_CELLS / 8 bytes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            page, subtree, kind, value = _listed(part)
            keep = np.flatnonzero(shared.value.passes(value))
            at = pa.array(page[keep])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(at) for c in names), pa.array(subtree[keep]), pa.array(kind[keep])],
                names=[*names, "subtree", "kind"],
            )

    names = ["host", "section", "address", "key", "main"]
    schema = "host string, section string, address long, key long, main long, subtree long, kind int"
    return saved(found.mapInArrow(run, schema), "repeated")


def templates(rows: DataFrame, share: float, least: int, most: int, nearly: float, many: int) -> DataFrame:
    """(key, templates): the subtrees of each page that are templates of its host or of its first path segment there.

    Of a place's pages with different main text, a template is on at least two, on ``share`` and on ``least``; or at ``most`` different
    addresses, if it has more than a few words; paragraphs of an article are on ``nearly`` all and on ``many``.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        read = [Page(source) for source in part.column("html").to_pylist()]
        texts = [xxhash.xxh64_intdigest(p.main_text().encode("utf-8", "surrogatepass")) - (1 << 63) for p in read]
        found = [p.removable() for p in read]
        lists = [pa.array([[h for h, kind in f if kind == wanted] for f in found], pa.list_(pa.int64())) for wanted in KINDS]
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in names), pa.array(texts, pa.int64()), *lists], names=[*names, "main", *KINDS.values()]
        )

    names = ["host", "section", "place", "address", "key"]
    found = saved(map_slices(
        rows.select(*names, "html"), "html", run,
        "host string, section string, place long, address long, key long, main long, "
        + ", ".join(f"{name} array<long>" for name in KINDS.values()), SLICE_BYTES,
    ), "subtrees")
    single = _repeated(found)

    def frequent(*place: str) -> DataFrame:
        pages = found.select(*place, "main").distinct().groupBy(*place).agg(F.count("*").alias("pages"))
        what = [*place, "subtree", "kind"]
        counts = (  # each different main text counts at one of its addresses
            single.groupBy(*what, "main").agg(F.min("address").alias("address"))
            .groupBy(*what, "address").agg(F.count("*").alias("n"))
            .groupBy(*what).agg(F.sum("n").alias("n"), F.count("*").alias("addresses"))
        )
        often = F.when(F.col("kind") == LINE, (F.col("n") >= many) & (F.col("n") >= nearly * F.col("pages"))).otherwise(
            (F.col("n") >= share * F.col("pages")) | (F.col("kind") == LONG) & (F.col("addresses") >= most)
        )
        return splittable_join(counts.where(F.col("n") >= max(least, 2)), pages, place).where(often).select(*what)

    hits = [
        splittable_join(single.select("key", *place, "subtree", "kind"), frequent(*place), [*place, "subtree", "kind"])
        .select("key", F.when(F.col("kind") == LINE, F.bitwise_not("subtree")).otherwise(F.col("subtree")).alias("subtree"))
        for place in (["host"], ["host", "section"])
    ]
    return saved(hits[0].union(hits[1]).groupBy("key").agg(F.collect_set("subtree").alias("templates")), "templates")


def main_texts(
    pages: DataFrame, share: float = 0.25, least: int = 8, id: str = "page_id", url: str = "url", source: str = "html",
    most: int = 100, nearly: float = 0.9, many: int = 50,
) -> DataFrame:
    """(page_id, url, text) for each page: its article, blocks joined by one blank.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments go by element name, class, id
    or role; then subtrees that are templates of the host or of its first path segment go.  Character references are decoded, white space inside a block
    becomes one blank.  A page without an article element gives its main element, else all that is left of it.  A null
    page is empty, a null url is a host of its own; rows may repeat; cut-off pages end where they are cut.
    """
    rows = _pages(pages, id, url, source)
    hits = templates(rows, share, least, most, nearly, many)
    number = hits.count()
    if number:
        hits = F.broadcast(hits) if number <= BROADCAST_ROWS // 10 else hits
        rows = rows.join(hits, "key", "left")
    else:
        rows = rows.withColumn("templates", F.lit(None).cast("array<long>"))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        gone = [frozenset(t or ()) for t in part.column("templates").to_pylist()]
        texts = [Page(s).main_text(t) for s, t in zip(part.column("html").to_pylist(), gone)]
        return pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )

    return map_slices(
        rows.select("page_id", "url", "html", "templates"), "html", run, "page_id long, url string, text string", SLICE_BYTES
    )
