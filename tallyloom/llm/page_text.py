"""The main text of web pages: site templates are found by counting element subtrees per host.

Each page is read into blocks of text. Elements that are furniture by their tag, or by a class, role or id
that names it, go with all they hold; a wrapper of other elements that would take most of the page's text by
its name alone stays. A name is that of furniture if its last word is, not counting words for parts and
places behind it: ``left-sidebar``, ``comment-list``, ``related-posts`` and ``commentlist``, but neither
``social-security`` nor ``page-with-sidebar``. Each element of the rest that could be part of a site's template gets a hash of its
whole subtree; Spark counts for each host how many different contents hold a subtree, and those that recur
on many are deleted with their text. Pages with equal content count once, so copies of an article are no
template. Inside an article or ``main``, text elements (``TEXT_TAGS``: also list items and table rows) are
never templates by themselves, as articles quote each other; boxes, lists and tables may be. Elsewhere any
element may be.

Elements know the one around them and each block knows its innermost one, so a page of any depth is read,
hashed and cleared of deleted subtrees in one walk each.

The page's content is chosen by its amount of text: its articles if they hold most of what the page has
left, otherwise ``main`` with them, otherwise the body. The text is chosen after the deletion; the content
whose copies count once is chosen before it.

- Null or empty html: no blocks, empty text. Cut-off pages end where the html ends.
- Null URL, or one without a host: pages of one host named "".
- Repeated rows are extracted one by one. No pages: no rows.
- Only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import map_arrow, written
from tallyloom.llm.url_filter import url_host

#: Elements by what they mean for text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
FURNITURE = set(
    "head nav header footer aside form script style textarea title xmp iframe noembed noframes noscript template "
    "svg math canvas audio video object select button dialog menu".split()
)
BLOCKS = set(
    "html body address article blockquote center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hgroup hr legend li main ol p pre search section summary table caption thead tbody tfoot tr ul".split()
)
#: Words of a class, id or role that mark furniture.
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies disqus footer header menu nav navbar navigation newsletter notice notices "
    "popup promo promoted promotion related search share sharing sidebar social sponsor sponsored subscribe widget".split()
)
#: Words for parts and places of furniture, that may stand behind its own word.
PARTS = set(
    "area areas article articles author bar block body bottom box boxes button buttons column container content contents "
    "date feed footer form group header heading icon icons inner item items left link links list lists main meta outer panel "
    "post posts reply right row section sections signup slot slots stories story text thread title top unit wrap wrapper zone".split()
)
#: Furniture and a part in one word. Of the shortest word for furniture only the usual ones: it begins other words.
JOINED = {f + part for f in FURNITURE_WORDS for part in PARTS if len(f) > 2 or part in ("box", "container", "slot", "unit", "wrapper")}
#: Words that tell of a state: no-sidebar, page-with-comments.
STATES = {"no", "not", "has", "with", "without", "is"}
#: Elements of text, that an article may share with others.
TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt tr a b i em strong span code q cite u s small sub sup".split())
#: Regions as bits, and the share of the page's text that ``main`` holds at least.
MAIN, ARTICLE = 1, 2
LEAST_MAIN = 0.1
#: Elements that end an open element of the second kind.
ENDS = {"li": {"li"}, "dt": {"dd", "dt"}, "dd": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

TAG = re.compile(
    r"""<(?:!--(?:(?!-->).)*+(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>)""", re.S
)
CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UNSHOWN = re.compile(r"display\s*:\s*none", re.I)
#: Of the page's text, the share beyond which an element is no furniture by its name.
WRAPPER_SHARE = 0.75


def attribute_values(attributes: str) -> dict[str, str]:
    """The first value of each attribute."""
    values: dict[str, str] = {}
    for name, *value in ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), "".join(value))
    return values


def is_unseen(tag: str, values: dict[str, str]) -> bool:
    """Whether an element is furniture by its tag, or not shown."""
    if tag in FURNITURE:
        return True
    if not values or tag in ("html", "body", "main"):
        return False
    return "hidden" in values or values.get("aria-hidden", "").lower() == "true" or bool(UNSHOWN.search(values.get("style", "")))


def has_furniture_name(tag: str, values: dict[str, str]) -> bool:
    """Whether a class, role or id names furniture or a part of it; ids of text and sections tell of topics."""
    if not values or tag in ("html", "body", "main"):
        return False
    names = f"{values.get('class', '')} {values.get('role', '')}".split()
    if tag not in TEXT_TAGS and tag not in ("section", "article"):
        names += values.get("id", "").split()
    for name in names:
        words = [x.lower() for x in NAME_WORD.findall(name)]
        last = len(words) - 1
        while last >= 0 and words[last] in PARTS and words[last] not in FURNITURE_WORDS:
            last -= 1
        if last < 0 or words[last] not in FURNITURE_WORDS and words[last] not in JOINED:
            continue
        if tag == "article" and last > 0:  # its classes often tell of its surroundings
            continue
        if STATES.isdisjoint(words):
            return True
    return False


@dataclass
class Element:
    """``number`` is that of the innermost element, this one included, that may be deleted; -1 for none."""

    tag: str
    regions: int
    number: int = -1
    own: bool = False
    gone: bool = False
    unseen: bool = False
    named: int | None = None
    lost: int = 0
    wraps: bool = False
    inked: bool = False
    parts: list[str] = field(default_factory=list)


@dataclass
class Page:
    """Blocks in page order, each with its regions and the innermost element around it that may be deleted.

    Of such an element there are the hash of its subtree, 0 without text, and the next one around it.
    """

    texts: list[str] = field(default_factory=list)
    regions: list[int] = field(default_factory=list)
    elements: list[int] = field(default_factory=list)
    hashes: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)

    def without(self, deleted: set[int]) -> Page:
        """The page without the blocks inside of elements with one of these hashes."""
        gone: list[bool] = []
        for digest, parent in zip(self.hashes, self.parents):
            gone.append(digest in deleted or parent >= 0 and gone[parent])
        left = [i for i, element in enumerate(self.elements) if element < 0 or not gone[element]]
        rows = ([x[i] for i in left] for x in (self.texts, self.regions, self.elements))
        return Page(*rows, self.hashes, self.parents)

    def content(self) -> list[tuple[str, int]]:
        """The blocks of the region that is the content, chosen by the amounts of text."""
        amounts = [0] * 4
        for text, regions in zip(self.texts, self.regions):
            amounts[regions] += len(text)
        whole, articles = sum(amounts), amounts[ARTICLE] + amounts[MAIN | ARTICLE]
        main = amounts[MAIN] + amounts[MAIN | ARTICLE]
        chosen = MAIN | ARTICLE if main and main >= LEAST_MAIN * whole else 0
        if 2 * articles > (whole - amounts[0] if chosen else whole):
            chosen = ARTICLE
        return [(t, e) for t, r, e in zip(self.texts, self.regions, self.elements) if not chosen or r & chosen]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Reader:
    """Reads one page; an element's subtree hash is ready when the element ends.

    Elements with a furniture name are numbered; those in ``wrappers`` stay. If one that went held most of
    the page's text, the page is read once more with it as a wrapper.
    """

    def __init__(self, wrappers: frozenset[int] = frozenset()) -> None:
        self.wrappers, self.n_named = wrappers, 0
        self.lost: dict[int, int] = {}
        self.page = Page()
        self.stack = [Element("", 0)]
        self.open_tags: Counter[str] = Counter()
        self.text: list[str] = []
        self.inked = False
        self.block = self.stack[0]

    def flush(self) -> None:
        """Ends the block of text that is being gathered."""
        text = " ".join("".join(self.text).split())
        self.text, self.inked = [], False
        if not text:
            return
        self.block.inked = True
        self.block.parts.append(text)
        self.page.texts.append(text)
        self.page.regions.append(self.block.regions)
        self.page.elements.append(self.block.number)

    def add(self, text: str) -> None:
        if self.stack[-1].gone:
            self.stack[-1].lost += len(text.strip())
            return
        if not self.inked:
            self.block, self.inked = self.stack[-1], not text.isspace()
        self.text.append(html.unescape(text) if "&" in text else text)

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self.flush()
            self.end_to({"p"}, barrier={"article", "main", "section", "div", "td", "th", "body"})
        if tag in ENDS:
            self.end_to(ENDS[tag], barrier={"ul", "ol", "dl", "table", "article", "main", "section", "div"})
        parent = self.stack[-1]
        parent.wraps |= tag in BLOCKS
        values = attribute_values(attributes) if attributes and not attributes.isspace() else {}
        unseen, named = is_unseen(tag, values), None
        if not unseen and has_furniture_name(tag, values):
            named, self.n_named = self.n_named, self.n_named + 1
            if named in self.wrappers:
                named = None
        furniture = unseen or named is not None
        region = tag in ("article", "main") and not furniture
        regions = parent.regions | {"article": ARTICLE, "main": MAIN}[tag] if region else parent.regions
        if tag in ("td", "th", "br"):
            self.add(" ")
        if tag in VOID:
            return
        gone = furniture or parent.gone and not region
        own = not (gone or region or tag in ("html", "body") or regions and tag in TEXT_TAGS)
        number = parent.number
        if own:
            number = len(self.page.hashes)
            self.page.hashes.append(0)
            self.page.parents.append(parent.number)
        self.open_tags[tag] += 1
        self.stack.append(Element(tag, regions, number, own, gone, unseen, named))

    def end_to(self, tags: set[str], barrier: set[str]) -> None:
        """Ends the nearest open element of ``tags``, unless one of ``barrier`` stands in between."""
        if not any(self.open_tags[x] for x in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i].tag in barrier:
                return

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if self.open_tags[tag]:
            while self.stack[-1].tag != tag:
                self.pop()
            self.pop()

    def pop(self) -> None:
        element = self.stack[-1]
        if element.tag in BLOCKS or element.gone:
            self.flush()
        self.stack.pop()
        self.open_tags[element.tag] -= 1
        outer = self.stack[-1]
        if self.block is element:
            self.block = outer
        if not element.unseen:
            outer.lost += element.lost
            outer.wraps |= element.wraps
            if element.named is not None and element.wraps:
                self.lost[element.named] = element.lost
        if element.gone or not element.inked:
            return
        digest = xxhash.xxh3_64_intdigest("\x00".join([element.tag, *element.parts]))
        outer.parts.append(f"\x01{digest:x}")
        outer.inked = True
        if element.own:
            self.page.hashes[element.number] = _signed(digest)

    def read(self, source: str) -> Page:
        at, last = 0, source.rfind(">")
        while at <= last and (match := TAG.search(source, at)):
            if match.start() > at:
                self.add(source[at : match.start()])
            at = match.end()
            tag = match[2] and match[2].lower()
            if not tag:
                continue
            if match[1]:
                self.end(tag)
                continue
            self.start(tag, match[3])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                at = close.start() if close else len(source)
        cut = CUT_TAG.search(source, at)
        self.add(source[at : cut.start() if cut else None])
        self.flush()
        while len(self.stack) > 1:
            self.pop()
        whole = self.stack[0].lost + sum(map(len, self.page.texts))
        wrappers = frozenset(x for x, n in self.lost.items() if n > WRAPPER_SHARE * whole)
        return self.page if self.wrappers or not wrappers else Reader(wrappers).read(source)


def _content_hash(page: Page) -> int:
    return _signed(xxhash.xxh3_64_intdigest("\x00".join(text for text, _ in page.content())))


def contents(df: DataFrame, url_column: str, html_column: str) -> DataFrame:
    """Per row: host, ``content`` (a hash of the page's content), ``marks`` (hashes of what may be template)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pages = [Reader().read(x.as_py() or "") for x in batch.column(1)]
        marks = pa.array([sorted(set(page.hashes) - {0}) for page in pages], pa.list_(pa.int64()))
        hashes = pa.array([_content_hash(x) for x in pages], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), hashes, marks], ["host", "content", "marks"])

    narrow = df.select(url_host(F.col(url_column)).alias("host"), F.col(html_column).alias("html"))
    return map_arrow(narrow, work, "host string, content long, marks array<long>")


#: What of a page goes from reading it to clearing it of templates.
KINDS = {"texts": pa.string(), "regions": pa.int32(), "elements": pa.int32(), "hashes": pa.int64(), "parents": pa.int32()}


def read_pages(df: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """Per row: id, url, host, ``content``, and the page's blocks and elements as in ``Page``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pages = [Reader().read(x.as_py() or "") for x in batch.column(2)]
        lists = [pa.array([getattr(x, name) for x in pages], pa.list_(kind)) for name, kind in KINDS.items()]
        hashes = pa.array([_content_hash(x) for x in pages], pa.int64())
        return pa.RecordBatch.from_arrays([*batch.columns[:2], hashes, *lists], ["id", "url", "content", *KINDS])

    narrow = df.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    schema = (
        f"id {dict(narrow.dtypes)['id']}, url string, content long, texts array<string>, regions array<int>, "
        "elements array<int>, hashes array<long>, parents array<int>"
    )
    return map_arrow(narrow, work, schema).withColumn("host", url_host(F.col("url")))


def templates(pages: DataFrame, least_pages: int, least_share: float, many_pages: int) -> DataFrame:
    """(host, mark) of the subtrees that recur on the host's different contents.

    They are on at least ``least_pages`` contents, and on ``least_share`` of all or on ``many_pages``, so
    that what is asked of a subtree does not grow with a large host.
    """
    sizes = pages.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("contents"))
    marks = pages.select("host", "content", F.explode("marks").alias("mark")).distinct()
    counted = marks.groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    least = F.least(least_share * F.col("contents"), F.lit(many_pages))
    return counted.join(sizes, "host").where(F.col("n") >= least).select("host", "mark")


def extract_text(
    df: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least_pages: int = 4,
    least_share: float = 0.25,
    many_pages: int = 20,
) -> DataFrame:
    """Per row: id, url, ``text``, ``n_chars``, ``n_deleted`` (blocks that went with the site's template).

    Pages are read twice, once for the counts and once for the text, so that no text is written between.
    What is deleted is a written table, so Spark knows its size when it picks the join.
    """
    found = written(contents(df, url_column, html_column), "page-marks")
    marks = found.select("host", "content", F.explode("marks").alias("mark")).distinct()
    deleted = (
        marks.join(templates(found, least_pages, least_share, many_pages), ["host", "mark"])
        .groupBy("host", "content")
        .agg(F.collect_set("mark").alias("deleted"))
    )
    deleted = written(deleted, "page-templates")
    pages = read_pages(df, id_column, url_column, html_column).join(deleted, ["host", "content"], "left")

    def clear(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_chars, n_deleted = [], [], []
        for *lists, deleted in zip(*(x.to_pylist() for x in batch.columns[2:])):
            page = Page(*lists)
            left = page.without(set(deleted)) if deleted else page
            texts.append("\n\n".join(text for text, _ in left.content()))
            n_chars.append(len(texts[-1]))
            n_deleted.append(len(page.texts) - len(left.texts))
        found = [pa.array(texts, pa.string()), pa.array(n_chars, pa.int64()), pa.array(n_deleted, pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *found], ["id", "url", "text", "n_chars", "n_deleted"])

    kind = dict(pages.dtypes)["id"]
    cleared = map_arrow(pages.select("id", "url", *KINDS, "deleted"), clear, f"id {kind}, url string, text string, n_chars long, n_deleted long")
    return cleared.withColumnsRenamed({"id": id_column, "url": url_column})
