"""Main text of web pages, without what a site repeats on its pages.

Every element without an article is hashed with all that is in it; Spark counts the
hashes by host over different articles, and elements that recur go. Running text goes
only beside articles that share little else, as copies of an article recur as well. What
is page furniture by its tag or class goes too, and of what is left the article's blocks
count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrow import extended, raw
from .common import checkpointed, stored, table

#: An element recurs if it stands beside SHARE of the host's different articles, FLOOR at
#: least; if it is no running text or mostly links, RECURS are enough on large hosts.
RECURS, SHARE, FLOOR = 10, 0.5, 3
#: Kinds of elements: containers, mostly link text, running text.
CONTAINER, LINKS, TEXT = 0, 1, 2
#: Removal lists are broadcast up to so many rows; beyond, they are shuffled.
BROADCAST_PAGES = 100_000

#: The markup language's elements by what they are.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul"
    .split()
)
HIDDEN = frozenset(
    "aside button canvas datalist dialog embed footer form head header iframe input math menu "
    "nav noscript object script select style svg template textarea title video audio map".split()
)
#: Elements that hold running text: copies of an article repeat them as well.
RUNNING = frozenset(
    "a abbr b blockquote br caption cite code dd dl dt em figcaption figure font h1 h2 h3 h4 h5 "
    "h6 hr i img kbd li mark ol p pre q s samp small span strike strong sub sup table tbody td "
    "tfoot th thead time tr tt u ul var wbr".split()
)
#: Tags whose start ends an open element of the second kind.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
#: Elements that an end or a start inside them does not reach beyond.
WALLS = frozenset("article aside body div footer form header main nav section table ul ol dl td th".split())
LIST_WALLS = WALLS - {"td", "th"}
ARTICLE, NOTHING = frozenset(("article",)), frozenset()
#: Whole names of class, id and role that say page furniture; other names are left to recurrence.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies disqus footer masthead menu modal "
    "nav navbar navigation newsletter notice notices notification pagination popup promo "
    "promotion related replies reply search share sharing sidebar social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r".*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Element:
    __slots__ = ("attrs", "digest", "free", "items", "tag")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.items, self.digest, self.free = tag, attrs, [], b"", False

    def furniture(self) -> bool:
        if self.tag in HIDDEN:
            return True
        if not self.attrs or self.tag in ("html", "body"):
            return False
        names = " ".join(x for found in _NAMES.findall(self.attrs) for x in found).lower()
        return not FURNITURE.isdisjoint(names.split())


def parse(html: str) -> Element:
    """The page as a tree. Missing end tags are put in, stray ones ignored."""
    root = Element("#page")
    stack, open_tags, at = [root], {"#page": 1}, 0

    def close(depth: int) -> None:
        for done in stack[-depth:]:
            open_tags[done.tag] -= 1
        del stack[-depth:]

    def end(tags: tuple[str, ...], walls: frozenset) -> None:
        """Closes up to the innermost of the tags, if it is not behind a wall."""
        for depth, element in enumerate(reversed(stack), 1):
            if element.tag in tags:
                close(depth)
                return
            if element.tag in walls:
                return

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            stack[-1].items.append(unescape(html[at:m.start()]))
        at = m.end()
        _, slash, tag, attrs, slash2, tag2, attrs2 = m.groups()
        tag = tag or tag2
        if not tag:
            continue
        tag, attrs = tag.lower(), attrs or attrs2 or ""
        if slash or slash2:
            if stack[-1].tag == tag:
                close(1)
            elif open_tags.get(tag):
                end((tag,), ARTICLE if tag != "article" else NOTHING)
            continue
        if tag in BLOCKS and open_tags.get("p"):
            end(("p",), WALLS)
        if tag in ENDS:
            end(ENDS[tag], LIST_WALLS if tag in ("td", "th", "tr") else WALLS)
        element = Element(tag, attrs)
        stack[-1].items.append(element)
        if tag not in VOID:
            stack.append(element)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    if at < len(html):
        stack[-1].items.append(unescape(html[at:]))
    return root


def _walk(top: Element, skip) -> Iterator[tuple[Element, int]]:
    """Elements in page order, with 1 at the start of one and -1 at its end; texts are
    left to the caller. Elements that skip holds for are passed over."""
    stack = [(top, iter(top.items))]
    yield top, 1
    while stack:
        element, items = stack[-1]
        for item in items:
            if isinstance(item, Element):
                if not skip(item):
                    yield item, 1
                    stack.append((item, iter(item.items)))
                    break
            else:
                yield item, 0
        else:
            stack.pop()
            yield element, -1


def blocks(top: Element, skip) -> list[str]:
    out, held = [], []

    def flush() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    for item, kind in _walk(top, skip):
        if kind == 0:
            held.append(item)
        elif item.tag in BLOCKS:
            flush()
        elif item.tag == "br":
            held.append(" ")
    flush()
    return out


def _articles(page: Element, skip) -> list[Element]:
    """The outermost article elements, else main elements, else the page."""
    for tag in ("article", "main"):
        found, inside = [], 0
        for item, kind in _walk(page, skip):
            if kind and item.tag == tag:
                if kind > 0 and not inside:
                    found.append(item)
                inside += kind
        if found:
            return found
    return [page]


def _teaser(article: Element, skip) -> bool:
    """Whether more than half of the characters are in links, or there are none."""
    chars = links = inside = 0
    for item, kind in _walk(article, skip):
        if kind == 0:
            size = len("".join(item.split()))
            chars += size
            links += size if inside else 0
        elif item.tag == "a":
            inside += kind
    return 2 * links > chars or not chars


def _joined(articles: list[Element], skip) -> str:
    """The blocks of all articles in page order; teasers only if there is nothing else."""
    own = [x for x in articles if not _teaser(x, skip)] if len(articles) > 1 else articles
    return "\n".join(text for x in own or articles for text in blocks(x, skip))


class _Open:
    """What is known of an element while its items are read."""

    __slots__ = ("chars", "content", "element", "holds", "inline", "links", "said", "words")

    def __init__(self, element: Element, holds: bool):
        self.element, self.holds, self.content = element, holds, [element.tag, element.attrs]
        self.chars = self.links = 0  # of the text, and of that in links
        self.words = False  # has text of its own
        self.said = False  # has that, or has it in phrases
        self.inline: list[tuple[Element, bool]] = []  # phrases that may stand alone, and if links


def parts(page: Element) -> tuple[str, dict[bytes, tuple[int, int]], int]:
    """The article's text, the digests of the elements that may go (those without an
    article in them) with their kind and how often they stand in the article with words
    of their own (-1: not in the article), and how many of the article's elements, links
    aside, have words of their own. Sets digest and free of all elements.

    A phrase (b, a, span ...) is part of its block, unless it stands by itself in a
    container without words of its own."""
    skip = Element.furniture
    found = _articles(page, skip)
    text = _joined(found, skip)
    keep = {id(x) for x in found}
    path: list[_Open] = []
    marks: dict[bytes, tuple[int, int]] = {}
    inside = units = 0

    def mark(element: Element, kind: int, counts: bool) -> None:
        element.free = True
        before = marks.get(element.digest, (kind, -1))[1]
        within = inside and not element.furniture()
        marks[element.digest] = (kind, max(before, 0) + counts if within else before)

    for item, kind in _walk(page, lambda x: False):
        if kind == 0:
            plain = " ".join(item.split())
            path[-1].content.append(plain)
            path[-1].chars += len(plain)
            if not path[-1].words and any(map(str.isalnum, plain)):
                path[-1].words = path[-1].said = True
        elif kind > 0:
            own = id(item) in keep
            inside += own
            path.append(_Open(item, own))
        else:
            at = path.pop()
            element, above = at.element, path[-1] if path else None
            element.digest = hashlib.blake2b(
                "\0".join(at.content).encode(errors="replace"), digest_size=8
            ).digest()
            if element.tag == "a":
                at.links = at.chars
            mostly_links = 2 * at.links > at.chars
            running = element.tag in RUNNING
            if not running and not at.words:
                for phrase, link in at.inline:
                    mark(phrase, LINKS if link else TEXT, not link)
                    units += bool(inside) and not link
            elif at.inline:
                at.said = True
            block = not running or element.tag in BLOCKS
            if block and at.said and inside and not element.furniture():
                units += not (running and mostly_links)
            if not at.holds:
                if not running:
                    mark(element, CONTAINER, False)
                elif element.tag not in VOID and at.chars and element.tag in BLOCKS:
                    mark(element, LINKS if mostly_links else TEXT, at.said and not mostly_links)
            inside -= id(element) in keep
            if above:
                above.content.append(element.digest.hex())
                above.holds |= at.holds
                if not element.furniture():
                    above.chars += at.chars
                    above.links += at.links
                    if not block and not at.holds and at.chars:
                        if above.element.tag in RUNNING:
                            above.said |= at.said
                        elif at.said:
                            above.inline.append((element, mostly_links))
    return text, marks, units


def without(page: Element, recurring: frozenset[bytes]) -> str:
    """The article's text when the recurring elements are gone. The digests must be set."""
    def skip(x: Element) -> bool:
        return (x.free and x.digest in recurring) or x.furniture()

    return _joined(_articles(page, skip), skip)


MARKS = "array<struct<digest:binary,kind:int,times:int>>"


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([
        ("digest", pa.binary()), ("kind", pa.int32()), ("times", pa.int32()),
    ]))
    for batch in batches:
        found = [parts(parse(x.decode(errors="replace"))) for x in raw(batch.column("body"))]
        yield extended(
            batch, "body",
            text=pa.array([x for x, _, _ in found], pa.string()),
            marks=pa.array([[
                {"digest": d, "kind": k, "times": n} for d, (k, n) in sorted(x.items())
            ] for _, x, _ in found], kind),
            units=pa.array([x for _, _, x in found], pa.int32()),
        )


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for body, gone in zip(raw(batch.column("body")), batch.column("gone").to_pylist(), strict=True):
            page = parse(body.decode(errors="replace"))
            parts(page)
            texts.append(without(page, frozenset(gone)))
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"),
            "text": pa.array(texts, pa.string()),
        })


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_PAGES else df


def extract(pages: DataFrame, recurs: int = RECURS) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html).

    A null html has an empty text; pages without a readable host are one host. Repeated
    rows give a row each. What is removed depends on a page's host and html only."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    body = pages.select(
        "page_id", "url", host.alias("host"), F.col("html").cast("binary").alias("body")
    ).withColumn("key", F.sha1(F.concat(
        F.encode(F.concat("host", F.lit("\n")), "UTF-8"), F.coalesce("body", F.lit(b""))
    )))
    seen = stored(body.select("page_id", "url", "key", "host", "body").mapInArrow(
        _seen, f"page_id long, url string, key string, host string, text string, marks {MARKS}, "
        "units int",
    ), "subtrees")
    article = F.xxhash64("text").alias("article")
    # pages that are copies of one another are one article
    hosts = checkpointed(seen.filter("text <> ''").groupBy("host", article).agg(
        F.lit(1).alias("one")
    ).groupBy("host").agg(F.greatest(
        F.lit(FLOOR), F.ceil(F.count("*") * SHARE)
    ).alias("limit")))
    single = seen.select("key", "host", article, "units", F.explode("marks").alias("m")).select(
        "key", "host", "article", "units", "m.*"
    )

    def counted(marks: DataFrame) -> DataFrame:
        """host, digest, kind, n (of different articles) and limit of what may recur."""
        return _small(hosts).join(marks.groupBy("host", "digest", "kind", "article").agg(
            F.lit(1).alias("one")
        ).groupBy("host", "digest", "kind").agg(F.count("*").alias("n")).filter(
            F.col("n") >= min(FLOOR, recurs)
        ), "host")

    often = checkpointed(counted(single).filter(F.col("n") >= F.when(
        F.col("kind") == TEXT, F.col("limit")
    ).otherwise(F.least("limit", F.lit(recurs)))).select("host", "digest", "kind"))
    plain = often.filter(F.col("kind") != TEXT).drop("kind")
    repeated = often.filter(F.col("kind") == TEXT)
    if not repeated.isEmpty():  # of running text, what articles have beside much of their own
        shared = single.filter((F.col("kind") == TEXT) & (F.col("times") >= 0)).join(
            _small(repeated), ["host", "digest", "kind"]
        ).distinct()
        beside = shared.groupBy("key").agg(
            F.first("host").alias("host"), F.first("article").alias("article"),
            F.first("units").alias("units"), F.sum("times").alias("times"),
            F.collect_set("digest").alias("digests"),
        ).filter(2 * F.col("times") <= F.col("units"))
        proven = counted(beside.select(
            "host", "article", F.lit(TEXT).alias("kind"), F.explode("digests").alias("digest")
        )).filter(F.col("n") >= F.col("limit"))
        plain = checkpointed(plain.union(proven.select("host", "digest")))
    gone = checkpointed(
        single.filter(F.col("times") >= 0).select("key", "host", "digest")
        .join(_small(plain), ["host", "digest"]).groupBy("key")
        .agg(F.collect_set("digest").alias("gone"))
    )
    out = seen.select("page_id", "url", "key", "text")
    if not gone.isEmpty():  # only pages that lose an element are read again
        gone = _small(gone)
        again = body.join(gone, "key").select("page_id", "url", "body", "gone").mapInArrow(
            _again, "page_id long, url string, text string"
        )
        out = out.join(gone, "key", "left_anti").select("page_id", "url", "text").union(again)
    out = out.select("page_id", "url", "text")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
