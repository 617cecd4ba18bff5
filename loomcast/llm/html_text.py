"""Main text of web pages by nearest-URL differencing, guarded by structure.

A page is read into lines, one for each block of text. Elements that declare themselves
as menus, headers, footers, sidebars, notices, adverts, forms or comments are left out,
and lines inside an explicit article always stay, because pages also share lines of their
articles. The other lines, the loose ones, are decided by differencing: the pages that
have some are ordered by host, path and url, each url is paired with the url beside it on
its host that shares the longer path prefix, the loose lines of the two are aligned by
longest common subsequence, and those shared are deleted.

The order is taken over urls alone and held together across the edges of partitions, so
that the pairs, and the texts, are the same at any number of partitions. A hot host
spreads over many tasks; a hot url is one row in the table of pairs.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import cut
from loomcast.llm.url_filter import split_url

_MARKUP = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Text up to the closing tag is no text of the page.
RAW = frozenset("script style noscript template iframe svg object select textarea canvas audio video head title".split())
DROPPED = frozenset("nav header footer aside form dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Inline markup carries no structure that matters here.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words in class or id that name what is not the article, wherever they stand in a name.
CHROME = frozenset(
    "ad ads advert adverts advertisement breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer masthead menu modal nav "
    "navbar navigation newsletter pagination popup promo sidebar sponsor sponsored subscribe toolbar".split()
)
#: Words that do so alone or beside words of layout only (share-buttons, not share-price; site-header, not article-header).
WEAK = frozenset("banner header hidden notice promotion related share sharing social widget".split())
LAYOUT = frozenset("area articles bar block bottom box button buttons container global icons left links list main page posts right section site sticky stories top wrapper".split())


#: Words that do so inside an article too, beside words of layout and numbers only (comments-2, ad-slot; not comment-on-policy).
FOREIGN = frozenset("ad ads advert adverts advertisement comment comments consent cookie cookies disqus newsletter promo sponsor sponsored".split())
FITTINGS = frozenset("author banner body content form header item items notice popup reply replies slot thread unit wrap".split())


def _names_foreign(name: str) -> bool:
    parts = {x for x in re.split(r"[^a-z0-9]+", name) if x and not x.isdigit()}
    return bool(parts & FOREIGN) and parts <= FOREIGN | LAYOUT | FITTINGS


def _names_chrome(name: str) -> bool:
    parts = set(re.split(r"[^a-z0-9]+", name)) - {""}
    return bool(parts & CHROME) or bool(parts & WEAK) and parts <= WEAK | LAYOUT


def _is_chrome(tag: str, attrs: str, inside: bool) -> bool:
    """Whether an element declares itself not to be the article; inside one, its own header counts as text and names must match whole, or be of comments, adverts or consent."""
    if tag in DROPPED and not (inside and tag == "header"):
        return True
    if not attrs:
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            if inside and any(x in CHROME or x in WEAK - {"header"} or _names_foreign(x) for x in value.split()) or not inside and any(map(_names_chrome, value.split())):
                return True
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _is_article(tag: str, attrs: str) -> bool:
    """Whether an element is the article itself; main is a container, in which differencing decides."""
    return tag == "article" or "articleBody" in attrs


def page_lines(page: str) -> list[tuple[str, bool]]:
    """(line, inside an article) for each block of text outside dropped elements, in page order.

    One pass: each tag is looked up and closed in constant time, whatever is left open.
    """
    out: list[tuple[str, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, dropped, in an article
    at_depth: dict[str, list[int]] = {}  # places in the stack of each open tag
    unclosed: set[str] = set()  # raw elements without a closing tag in the rest of the page
    dropped = inside = False

    def close() -> None:
        line = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if line:
            out.append((line, inside))

    def pop_to(n: int) -> None:
        nonlocal dropped, inside
        while len(stack) > n:
            at_depth[stack.pop()[0]].pop()
        dropped, inside = stack[-1][1:] if stack else (False, False)

    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else end]
        if text and not dropped:
            held.append(text)
        if not m:
            break
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCKS:
                close()
            if at_depth.get(tag):
                pop_to(at_depth[tag][-1])
            continue
        if tag in RAW:
            closing = None if tag in unclosed else re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if closing is None:
                unclosed.add(tag)
            if closing or tag in ("script", "style"):
                at = closing.end() if closing else end
            if tag not in ("title", "head"):
                held.append(" " if not dropped else "")
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCKS:
            close()
            if stack and stack[-1][0] == "p":
                pop_to(len(stack) - 1)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        chrome = _is_chrome(tag, m[3], inside)
        if chrome and not dropped:
            close()
        if tag not in INLINE or chrome:
            dropped, inside = dropped or chrome, inside or _is_article(tag, m[3])
            at_depth.setdefault(tag, []).append(len(stack))
            stack.append((tag, dropped, inside))
    close()
    return out


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in a of a longest common subsequence of lines, by bit-parallel dynamic programming.

    Of the rows of bits, one in about the root of their number is kept; the rows between
    two kept ones are worked out anew on the way back. So memory grows with the lines to
    the power of one and a half.
    """
    both = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in both]
    right = [x for x in b if x in both]
    if not left:
        return set()
    masks: dict[str, int] = {}
    for j, x in enumerate(right):
        masks[x] = masks.get(x, 0) | 1 << j
    full, step = (1 << len(right)) - 1, max(1, isqrt(len(left)))

    def after(row: int, i: int) -> int:
        u = row & masks[a[left[i]]]
        return ((row + u) | (row - u)) & full

    row, kept = full, {0: full}
    for i in range(len(left)):
        row = after(row, i)
        if (i + 1) % step == 0:
            kept[i + 1] = row
    found, i, j, rows, base = set(), len(left), len(right), [], len(left) + 1
    while i and j:
        if i - 1 < base:  # rows i - 1 and i are needed: work out the stretch that holds them
            base = (i - 1) // step * step
            rows = [kept[base]]
            for k in range(base, i):
                rows.append(after(rows[-1], k))
        if rows[i - base] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if rows[i - base] >> (j - 1) & 1:
                found.add(left[i])
                j -= 1
    return found


def kept_lines(lines: list[str], loose: list[int], pair: list[str] | None) -> list[str]:
    """The lines that stay, given the loose lines of the paired page."""
    if not pair:
        return lines
    gone = {loose[i] for i in shared_lines([lines[i] for i in loose], pair)}
    return [x for i, x in enumerate(lines) if i not in gone]


def _parsed(pages: DataFrame, kind: str) -> DataFrame:
    """(id, url, lines, loose): each page's lines and the places of those outside articles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [page_lines(page.as_py() or "") for page in part.column(2)]
                lines = pa.array([[x for x, _ in f] for f in found], pa.list_(pa.string()))
                loose = pa.array([[i for i, (_, inside) in enumerate(f) if not inside] for f in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lines, loose], names=["id", "url", "lines", "loose"])

    return pages.mapInArrow(run, f"id {kind}, url string, lines array<string>, loose array<int>")


def _shared_prefix(a: Column, b: Column) -> Column:
    """How many characters two strings have in common at their start."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.length(a).cast("long"))


def nearest_urls(urls: DataFrame) -> DataFrame:
    """(url, pair) for distinct (host, path, url): the url beside it on its host with the longer common path prefix, the one before on a tie.

    Urls are range-partitioned and pinned by a checkpoint; neighbours inside a partition
    come from a window over it, those across its edges from the partitions' first and
    last urls, two rows a partition.
    """
    key = F.struct("host", "path", "url")
    ordered = cut(urls.repartitionByRange("host", "path", "url").select(key.alias("k"), F.spark_partition_id().alias("part")))
    within = Window.partitionBy("part").orderBy("k")
    ends = ordered.groupBy("part").agg(F.min("k").alias("first"), F.max("k").alias("last"))
    over = Window.orderBy("part")  # a row a partition
    edges = ends.select("part", F.lag("last").over(over).alias("left"), F.lead("first").over(over).alias("right"))
    near = ordered.withColumns({"before": F.lag("k").over(within), "after": F.lead("k").over(within)}).join(edges, "part")
    beside = {x: F.coalesce(x, edge) for x, edge in (("before", "left"), ("after", "right"))}
    near = near.select("k", *(F.when(c["host"] == F.col("k.host"), c).alias(x) for x, c in beside.items()))
    first = F.col("after").isNull() | (_shared_prefix(F.col("k.path"), F.col("before.path")) >= _shared_prefix(F.col("k.path"), F.col("after.path")))
    pair = F.when(F.col("before").isNotNull() & first, F.col("before.url")).otherwise(F.col("after.url"))
    return near.select(F.col("k.url").alias("url"), pair.alias("pair")).where("pair is not null")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per row of pages; text is empty where no line stays.

    A null html is empty. Pages whose url is null or has no host have no pair and keep
    their loose lines; so do a host's pages if they all share one url. Pages of one url
    are not each other's pair: a page is only compared with the page of smallest id that
    has the paired url, so repeated rows get equal texts. Very long pages are read and
    aligned whole, in memory that grows less than their square. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    picked = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = cut(_parsed(picked, kind))
    whole = F.array_join("lines", "\n\n")
    named = split_url(parsed.where(F.size("loose") > 0), "url").withColumn("able", F.col("host") != "")
    # Of equal pages of a url and id the least lines are taken, so that the choice does not depend on row order.
    texts = F.transform("loose", lambda i: F.element_at("lines", i + 1))
    of_url = named.where("able").groupBy("host", "path", "url").agg(F.min_by(texts, F.struct(F.col("id").isNull(), "id", texts)).alias("other"))
    pairs = nearest_urls(of_url.select("host", "path", "url"))
    others = pairs.join(of_url.select(F.col("url").alias("pair"), "other"), "pair").select("url", "other")
    compared = named.where("able").select("id", "url", "lines", "loose").join(others, "url", "left").select("id", "url", "lines", "loose", "other")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = zip(*[part.column(i).to_pylist() for i in (2, 3, 4)], strict=True)
                kept = pa.array(["\n\n".join(kept_lines(*row)) for row in rows], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), kept], names=["id", "url", "text"])

    out = compared.mapInArrow(differ, f"id {kind}, url string, text string")
    out = out.unionByName(parsed.where("size(loose) = 0").select("id", "url", whole.alias("text")))
    out = out.unionByName(named.where("not able").select("id", "url", whole.alias("text")))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
