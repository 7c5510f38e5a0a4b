"""Main text of web pages, with the templates of their sites removed.

Every element of a page gets a hash of its subtree: tag, words and the hashes
of its children, without attributes. Per host, Spark counts the different pages
that a subtree of the text recurs on. Recurring subtrees that consist mostly of
links are template. Others must also recur at one place: the same tags above
them and the same number among their siblings, from the first or from the last,
on nine of ten of these pages. Prose that pages quote here and there is content.
Inside ``article`` and ``main`` only boxes can be template, not single
paragraphs, headings or lists, and more pages are asked for than elsewhere.

Pages are different if their titles are, so copies of an article count once.
On a host where one title stands over many different pages, and for pages
without a title, it is the longest text block outside the subtree that tells
pages apart.

Besides, elements whose tag, role or class says that they are no part of an
article are left out. If a page has an ``article`` or ``main``, the text is
taken from there, but not from one within such an element.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage, text_slices

LEAST_PAGES = 5
LEAST_PAGES_INSIDE = 20  # inside article and main
ONE_PLACE = 0.9
SITE_TITLE = 0.2  # of a host's different pages have this title
MOSTLY_LINKS = 0.5

# Element names of HTML and their customary roles and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "noframes")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
BOXES = frozenset("address center details div fieldset figure section".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_TEXT = frozenset(
    "head script style noscript template svg math iframe object canvas audio video nav footer aside form button select "
    "textarea datalist dialog menu title xmp noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
CLASS_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login social share sharing "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead footer copyright related "
    "recommended recommendations comment comments commentlist disqus reply replies respond widget toolbar search skip".split()
)
OTHER_ARTICLES = frozenset(
    "comment comments reply replies related recommended sponsored promo ad advert advertisement teaser".split()
)
CLOSED_BY = {  # an open element of the second kind ends where one of the first begins
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "tbody", "thead"),
}
SCOPES = frozenset("ul ol dl table select td th tr body html article main section div".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NOT_ITSELF = ("has-", "no-", "not-", "with-", "without-", "is-")
_CLASS_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_END_OF_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}


class Node:
    __slots__ = (
        "barred", "digest", "dropped", "first", "holder", "items", "last", "link_words", "parent", "path", "places",
        "prose", "tag", "words",
    )

    def __init__(self, tag: str, dropped: bool, parent: Node | None):
        self.tag = tag
        self.dropped = dropped  # by tag, role or class
        self.parent = parent
        # is or lies in a dropped element; some sites wrap the whole page in a form
        self.barred = parent is not None and (parent.barred or (dropped and tag != "form"))
        self.items: list[Node | str] = []
        self.words = self.link_words = self.digest = 0
        self.holder = False  # is an article or main element
        self.prose = False  # is or holds one
        self.first = self.last = 0  # its text blocks
        self.path = 0  # hash of the tags from the holder, or the page, down
        self.places = (0, 0)  # with its number from the first and the last sibling


def _speaks_against(tag: str, attributes: str) -> bool:
    """Whether role, class, id or style say that an element is no article text."""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"' \t\r\n")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and _HIDDEN_STYLE.search(value):
            return True
        if name in ("class", "id"):
            names = value.split() if name == "class" else [value]
            names = [n for n in names if not n.lower().startswith(_NOT_ITSELF)]
            if any(part.lower() in CLASS_WORDS for n in names for part in _CLASS_PART.findall(n)):
                return True
    return False


def _is_prose(tag: str, attributes: str) -> bool:
    """Whether an element says that it holds the article, and not a reader's comment."""
    if tag != "article":
        return tag == "main"
    classes = [c for n, v in _ATTRIBUTE.findall(attributes) if n.lower() == "class" for c in v.strip("\"'").split()]
    begins = (_CLASS_PART.match(c) for c in classes)
    return not any(m and m[0].lower() in OTHER_ARTICLES for m in begins)


def parse(page: str) -> tuple[Node, str]:
    """The element tree of a page, lenient about missing tags, and its title."""
    root = node = Node("html", False, None)
    title, at, size = "", 0, len(page)
    while at < size:
        match = _TOKEN.search(page, at)
        text = page[at : match.start() if match else size]
        if text:
            node.items.append(text)
        if not match:
            break
        at = match.end()
        tag = (match[1] or "").lower()
        if not tag:
            continue
        if page[match.start() + 1] == "/":
            node = _closed(node, tag)
            continue
        attributes = match[2]
        if tag in ("html", "body"):
            continue
        if tag in BLOCKS and node.tag == "p":
            node = node.parent or root  # a block ends an open paragraph
        elif tag in BLOCKS:
            node = _closed(node, "p", within=BLOCKS)
        for open_tag in CLOSED_BY.get(tag, ()):
            node = _closed(node, open_tag, within=SCOPES - {open_tag})
        prose = not node.barred and _is_prose(tag, attributes)
        other = tag in NO_TEXT or tag == "article" or (bool(attributes.strip()) and _speaks_against(tag, attributes))
        child = Node(tag, other and not prose, node)
        node.items.append(child)
        if prose:
            child.holder = True
            above: Node | None = child
            while above is not None and not above.prose:
                above.prose = True
                above = above.parent
        if tag in RAW:
            end = _END_OF_RAW[tag].search(page, at)
            raw = page[at : end.start() if end else size]
            if tag == "title" and not title:
                title = " ".join(entities.unescape(raw).split())
            at = end.start() if end else size
            node = child
        elif tag not in VOID:  # a slash does not end an element that can hold text
            node = child
    return root, title


def _closed(node: Node, tag: str, within: frozenset[str] = frozenset()) -> Node:
    """The node that is open after ``tag`` ended; unchanged if none is open."""
    above: Node | None = node
    while above is not None and above.parent is not None:
        if above.tag == tag:
            return above.parent
        if above.tag in within:
            return node
        above = above.parent
    return node


def measure(root: Node) -> Iterator[Node]:
    """Set digest and word counts of every element, children first, and yield them."""
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, ready = stack.pop()
        if not ready:
            stack.append((node, True))
            stack += [(item, False) for item in node.items if isinstance(item, Node)]
            continue
        parts = [node.tag]
        for item in node.items:
            if isinstance(item, Node):
                if item.words:
                    parts.append(f"<{item.digest:x}>")
                    node.words += item.words
                    node.link_words += item.words if item.tag == "a" else item.link_words
            else:
                words = entities.unescape(item).split()
                node.words += len(words)
                parts += words
        if node.tag in ("script", "style", "noscript", "template", "title"):
            node.words = node.link_words = 0
        node.digest = xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "replace"))
        yield node


def _hash32(*parts: object) -> int:
    value = xxhash.xxh32_intdigest("\x1f".join(map(str, parts)))
    return value - (1 << 32) if value >> 31 else value


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _digest(text: str) -> int:
    return _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "replace")))


def _locate(node: Node) -> None:
    """Set path and places of the elements below ``node``."""
    below = [c for c in node.items if isinstance(c, Node) and c.words]
    above = 0 if node.holder or node.parent is None else node.path
    for at, child in enumerate(below):
        child.path = _hash32(above, child.tag)
        child.places = (_hash32(child.path, "first", at), _hash32(child.path, "last", len(below) - at))


def text_blocks(root: Node) -> tuple[list[str], list[tuple[Node, bool]]]:
    """The text blocks of a page, and the elements that may be template.

    An element comes with whether it lies inside an article or main element,
    and knows which blocks are its own.
    """
    only_prose = root.prose
    blocks: list[str] = []
    current: list[str] = []
    found: list[tuple[Node, bool]] = []

    def flush() -> None:
        words = entities.unescape("".join(current)).split()
        if words:
            blocks.append(" ".join(words))
        current.clear()

    # (node, inside an article, headings only, ready to be closed)
    stack: list[tuple[Node | str, bool, bool, bool]] = [(root, False, False, False)]
    while stack:
        item, inside, heads, ready = stack.pop()
        if isinstance(item, str):
            if (inside or not only_prose) and not heads:
                current.append(item)
            continue
        block = item.tag in BLOCKS
        if ready:
            if block:
                flush()
                item.last = len(blocks)
                if item.first < item.last and item.parent is not None and not item.prose:
                    found.append((item, inside))
            continue
        if item.tag == "br":
            current.append(" ")
            continue
        dropped = item.dropped and not item.prose
        header = item.tag == "header" or (dropped and item.tag == "div")
        if (dropped or item.tag == "header") and not item.prose:
            # the heading of an article may stand in a header of its own
            if not (inside and header and _has_heading(item)):
                if block:
                    flush()
                continue
            heads = True
        elif item.tag in HEADINGS:
            heads = False
        if block:
            flush()
            item.first = len(blocks)
        _locate(item)
        stack.append((item, inside, heads, True))
        inside = inside or item.holder
        stack += [(child, inside, heads, False) for child in reversed(item.items)]
    flush()
    return blocks, found


@dataclass(frozen=True)
class Part:
    """A subtree of a page's text that may be template."""

    whole: int  # hash of the subtree and its kind
    free: bool  # mostly links: template wherever it recurs
    inside: bool  # an article or main element
    context: int  # hash of the longest block outside
    start: int  # its place from the first sibling
    end: int  # and from the last
    first: int  # its text blocks
    last: int


@dataclass(frozen=True)
class Page:
    title: str
    lead: int  # hash of the longest block
    blocks: list[str]
    parts: list[Part]


def read_page(page: str) -> Page:
    """Title, text blocks and possible templates of a page."""
    root, title = parse(page)
    for _node in measure(root):
        pass
    blocks, found = text_blocks(root)
    # the longest block before and from every position on
    before, after = [-1], [-1] * (len(blocks) + 1)
    for i, block in enumerate(blocks):
        before.append(i if before[-1] < 0 or len(block) > len(blocks[before[-1]]) else before[-1])
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = i if after[i + 1] < 0 or len(blocks[i]) >= len(blocks[after[i + 1]]) else after[i + 1]
    digests: dict[int, int] = {-1: 0}

    def digest(at: int) -> int:
        if at not in digests:
            digests[at] = _digest(blocks[at])
        return digests[at]

    parts = []
    for node, inside in found:
        free = node.link_words > MOSTLY_LINKS * node.words
        if inside and node.tag not in BOXES and not free:
            continue
        outside = max(before[node.first], after[node.last], key=lambda i: len(blocks[i]) if i >= 0 else -1)
        whole = _digest(f"{node.digest:x} {free} {inside and not free}")
        parts.append(Part(whole, free, inside and not free, digest(outside), *node.places, node.first, node.last))
    return Page(title, digest(before[-1]), blocks, parts)


def main_text(page: str) -> str:
    """The text of a page whose site has no templates."""
    return "\n\n".join(read_page(page).blocks)


def _has_heading(node: Node) -> bool:
    stack: list[Node] = [node]
    while stack:
        for item in stack.pop().items:
            if isinstance(item, Node):
                if item.tag == "h1":
                    return True
                stack.append(item)
    return False


def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = pages[url_col].cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))
    page = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    return pages.select(pages[id_col].cast("long").alias("id"), url.alias("url"), host.alias("host"), page.alias("page"))


_PARTS = pa.list_(
    pa.struct(
        [
            ("whole", pa.int64()), ("free", pa.bool_()), ("inside", pa.bool_()), ("context", pa.int64()),
            ("start", pa.int32()), ("end", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
        ]
    )
)
_PAGE = (
    "id long, url string, host string, title long, lead long, blocks array<string>, parts array<struct<whole:long,"
    "free:boolean,inside:boolean,context:long,start:int,end:int,first:int,last:int>>"
)


def read_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Pages as text blocks and possible templates, each with a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "page"):
            read = [read_page(p) for p in batch.column("page").to_pylist()]
            made = [
                pa.array([_digest(p.title) if p.title else None for p in read], pa.int64()),
                pa.array([p.lead for p in read], pa.int64()),
                pa.array([p.blocks for p in read], pa.list_(pa.string())),
                pa.array([[vars(x) for x in p.parts] for p in read], _PARTS),
            ]
            names = ["id", "url", "host", "title", "lead", "blocks", "parts"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), *made], names)

    rows = _rows(pages, id_col, url_col, html_col).mapInArrow(run, _PAGE)
    return stage(rows.withColumn("uid", F.monotonically_increasing_id()), "pages")


def _parts(read: DataFrame) -> DataFrame:
    rows = read.select("uid", "host", "title", F.inline("parts"))
    return rows.withColumn("title", F.coalesce("title", "context"))


def _different_pages(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.countDistinct("title").alias("titles"), F.countDistinct("context").alias("texts"))


def _one_title_hosts(read: DataFrame, least: int) -> DataFrame:
    """Hosts with a title over many different pages, such as the site's name."""
    under = read.where("title IS NOT NULL").select("host", "title", "lead").distinct()
    titles = under.groupBy("host", "title").agg(F.count("*").alias("n"))
    hosts = titles.groupBy("host").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    wide = (F.col("most") >= least) & (F.col("most") >= SITE_TITLE * F.col("all"))
    return hosts.where(wide).select("host", F.lit(True).alias("wide"))


def templates_of(
    read: DataFrame, least_pages: int = LEAST_PAGES, least_pages_inside: int = LEAST_PAGES_INSIDE
) -> DataFrame:
    """``(host, whole, place)``: subtrees that are template, at any place if NULL."""
    hosts = stage(_one_title_hosts(read, least_pages), "hosts")
    n = F.when(F.col("wide"), F.greatest("titles", "texts")).otherwise(F.col("titles"))
    counted = _different_pages(_parts(read), "host", "whole", "free", "inside")
    # a host's title decides only where titles are too few
    counted = counted.where(F.greatest("titles", "texts") >= least_pages).join(hosts, "host", "left")
    least = F.when(F.col("inside"), F.lit(least_pages_inside)).otherwise(F.lit(least_pages))
    often = stage(counted.withColumn("n", n).where(F.col("n") >= least).drop("titles", "texts"), "often")
    fixed = often.where("NOT free").select("host", "whole", "wide", "n")
    places = _parts(read).where("NOT free").join(fixed, ["host", "whole"])
    places = places.withColumn("place", F.explode(F.array("start", "end")))
    placed = _different_pages(places, "host", "whole", "wide", "n", "place").where(n >= F.lit(ONE_PLACE) * F.col("n"))
    anywhere = often.where("free").select("host", "whole", F.lit(None).cast("int").alias("place"))
    return anywhere.unionByName(placed.select("host", "whole", "place"))


def site_templates(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = LEAST_PAGES,
    least_pages_inside: int = LEAST_PAGES_INSIDE,
) -> DataFrame:
    """``(host, whole, place)`` of the templates of every host."""
    return templates_of(read_pages(pages, id_col, url_col, html_col), least_pages, least_pages_inside)


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = LEAST_PAGES,
    least_pages_inside: int = LEAST_PAGES_INSIDE,
) -> DataFrame:
    """``(id, url, host, text)`` per row of ``pages``.

    NULL or empty html gives an empty text. Pages without a host are one host.
    Character references are decoded, white space in a block is one space, and
    blocks are joined by an empty line in page order. Repeated rows stay; they
    share their title and count once. Other columns are not read. An empty
    table gives no rows. Pages are joined with the blocks to be deleted by
    their number: no list is kept per host.
    """
    read = read_pages(pages, id_col, url_col, html_col)
    templates = stage(templates_of(read, least_pages, least_pages_inside), "templates")
    here = F.col("place").isNull() | F.col("place").isin(F.col("start"), F.col("end"))
    gone = _parts(read).join(templates, ["host", "whole"]).where(here)
    gone = stage(gone.groupBy("uid").agg(F.collect_set(F.struct("first", "last")).alias("gone")), "gone")
    joined = read.select("uid", "id", "url", "host", "blocks").join(gone, "uid", "left")

    def stays(_block: Column, at: Column) -> Column:
        return ~F.exists("gone", lambda part: (part["first"] <= at) & (at < part["last"]))

    left = F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(F.filter("blocks", stays))
    return joined.select("id", "url", "host", F.concat_ws("\n\n", left).alias("text"))
