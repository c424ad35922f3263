"""Main text of HTML pages by structure and nearest-URL page differencing.

Pages of a host are paired with the page nearest in URL path that is no copy.
Their lines (text blocks) are aligned by a longest common subsequence, and lines
that both share are template. Marked regions decide where they can: menus, footers, forms,
adverts and the like never count, and prose inside a marked article is kept
even if another page repeats it. All other lines are decided by differencing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import global_positions, slices, text_or_empty
from lapwise.llm.url_rules import host_of, path_of
from lapwise.session import materialised

# Pages with lines to cut, up to which the cuts are broadcast.
BROADCAST_ROWS = 100_000
# Pages are copies if their alignment leaves at most one in so many of their characters.
COPY = 20
# Positions in which copies are followed in one group.
BLOCK_ROWS = 4096
SLICE_BYTES = 8 << 20

# Names from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
# An open element of the key ends before any of the values starts.
ENDS_BEFORE = {
    "p": BLOCK - {"br"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "option": frozenset({"option"}),
    "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
}
# Regions that are never article text, by tag, role and words of class or id.
APART_TAGS = frozenset(
    "head nav footer aside form button select option textarea input label noscript template iframe object embed svg canvas "
    "audio video map dialog menu search script style title noembed noframes xmp".split()
)
APART_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status note".split())
APART_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer ad ads advert adverts advertisement advertising "
    "adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login register share sharing social comment comments disqus reply replies "
    "respond related recommended recommendations widget widgets toolbar pagination pager masthead copyright topbar search form".split()
)
HEADER_WORDS = frozenset({"header", "masthead"})
NOT_A_REGION = frozenset("has no with without js is open".split())
MAIN_NAMES = frozenset(
    "article articlebody article-body article-content article-text content main main-content page-content post post-body "
    "post-content entry entry-content story story-body".split()
)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


# Regions marked by class or id, by a main element or role, as an article.
NAMED, MAIN, ARTICLE = 1, 2, 4


class Line(NamedTuple):
    text: str
    # Sum of the kinds of marked region around it: NAMED, MAIN, ARTICLE; 0 outside any.
    level: int
    # All of its text is in links.
    links: bool


def _region(tag: str, attributes: str, in_main: int) -> tuple[bool, int]:
    """(apart from the article, kinds of main region) that an element starts."""
    level = ARTICLE if tag == "article" else MAIN if tag == "main" else 0
    apart = tag in APART_TAGS or (tag == "header" and not in_main)
    if not attributes.strip(" /"):
        return apart, level
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "role":
            apart |= value in APART_ROLES
            level |= MAIN if value == "main" else ARTICLE if value == "article" else 0
        elif name == "itemprop":
            level |= ARTICLE if value == "articlebody" else 0
        elif name == "hidden":
            apart = True
        elif name == "aria-hidden":
            apart |= value == "true"
        elif name == "style":
            apart |= bool(HIDDEN.search(value))
        elif tag not in ("html", "body"):
            for word in value.split():
                if word in MAIN_NAMES:
                    level |= NAMED
                parts = [p for p in re.split(r"[^a-z0-9]+", word) if p]
                if not parts or parts[0] in NOT_A_REGION or parts[-1] in NOT_A_REGION:
                    continue
                ends = {parts[0], parts[-1]}
                if tag in ("article", "main"):
                    ends &= {"comment", "comments", "reply"}
                apart |= bool(ends & APART_WORDS) or (not in_main and bool(ends & HEADER_WORDS))
    return apart, level


def page_lines(html: str) -> list[Line]:
    """The visible lines outside regions that are apart, in page order. Unclosed and stray tags do no harm."""
    lines: list[Line] = []
    pieces: list[str] = []
    plain = False
    # (tag, apart, level, inside a link) of every open element, each with what it inherits.
    stack: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]

    def flush() -> None:
        nonlocal plain
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                lines.append(Line(text, level, not plain))
            pieces.clear()
        plain = False

    at, size = 0, len(html)
    _, apart, level, link = stack[-1]
    while at < size:
        m = TOKEN.search(html, at)
        stop = m.start() if m else size
        if stop > at and not apart:
            piece = html[at:stop]
            pieces.append(piece)
            plain = plain or (not link and not piece.isspace())
        if not m:
            break
        at = m.end()
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            if tag == "br":
                if not apart:
                    pieces.append(" ")
                continue
            flush()
        if close:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    flush()
                    del stack[i:]
                    break
        elif tag not in VOID:
            if tag in BLOCK or tag in HEAD_ONLY:
                if tag not in HEAD_ONLY and tag != "head":
                    for i in range(1, len(stack)):
                        if stack[i][0] == "head":
                            del stack[i:]
                            break
                for i in range(len(stack) - 1, 0, -1):
                    if tag in ENDS_BEFORE.get(stack[i][0], ()):
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCK and stack[i][0] not in ENDS_BEFORE:
                        break
            _, apart, level, link = stack[-1]
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                at = end.start() if end else size
                if at < size:
                    at = html.find(">", at) + 1 or size
                continue
            own_apart, own_level = _region(tag, attributes, level)
            if own_apart and not apart:
                flush()
            stack.append((tag, apart or own_apart, level | own_level, link or tag == "a"))
        _, apart, level, link = stack[-1]
    flush()
    return lines


def shared_places(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places of `a` on a longest common subsequence with `b`, by bit-parallel rows."""
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, row = [], full
    for x in a:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out = []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(i)
    return out[::-1]


def are_copies(a: Sequence[int], a_sizes: Sequence[int], b: Sequence[int], b_sizes: Sequence[int]) -> bool:
    """Whether nearly all of the characters of both pages are in lines that they share."""
    if a == b:
        return True
    total = sum(a_sizes) + sum(b_sizes)
    return COPY * (total - 2 * sum(a_sizes[i] for i in shared_places(a, b))) <= total


def copy_runs(stand: DataFrame) -> DataFrame:
    """(at, host, at0, at1): positions of the last page before and the first after the run of copies that a page is in.

    Only pages whose prose differencing decides (`bare`) make runs.
    """
    before = stand.filter("bare").select((F.col("at") + 1).alias("b_at"), F.col("host").alias("b_host"), F.col("lines").alias("b_lines"), F.col("sizes").alias("b_sizes"))
    pairs = stand.join(before, F.col("bare") & (F.col("at") == F.col("b_at")) & (F.col("host") == F.col("b_host")), "left")
    pairs = pairs.select("at", "host", "lines", "sizes", "b_lines", "b_sizes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*[c.to_pylist() for c in batch.columns[2:]])
            first = [old is None or not are_copies(new, n, old, m) for new, n, old, m in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(first, pa.bool_())], names=["at", "host", "first"])

    runs = materialised(pairs.mapInArrow(compare, "at long, host string, first boolean"), "copy-runs")
    runs = runs.withColumn("block", F.floor(F.col("at") / BLOCK_ROWS))
    start = F.when(F.col("first"), F.col("at"))
    # Firsts of the blocks around: a table of one row per block, which bounds the broadcast.
    blocks = runs.groupBy("block").agg(F.min(start).alias("low"), F.max(start).alias("high"))
    past, coming = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.select("block", F.max("high").over(past).alias("p_start"), F.min("low").over(coming).alias("n_start"))
    place = Window.partitionBy("block").orderBy("at")
    own = F.max(start).over(place.rowsBetween(Window.unboundedPreceding, 0))
    following = F.min(start).over(place.rowsBetween(1, Window.unboundedFollowing))
    runs = runs.select("at", "host", "block", own.alias("own"), following.alias("following")).join(F.broadcast(blocks), "block")
    return runs.select("at", "host", (F.coalesce("own", "p_start") - 1).alias("at0"), F.coalesce("following", "n_start").alias("at1"))


def kept_places(lines: Sequence[Line]) -> list[int]:
    """Lines in marked regions of any kind; all lines if there are none, or if more prose is outside than in them and no main is marked."""
    inside = sum(len(line.text) for line in lines if line.level and not line.links)
    outside = sum(len(line.text) for line in lines if not line.level and not line.links)
    everything = not any(line.level for line in lines) or (outside > inside and not any(line.level & MAIN for line in lines))
    return [i for i, line in enumerate(lines) if everything or line.level]


def open_places(lines: Sequence[Line]) -> list[int]:
    """Kept lines that differencing decides: those outside marked regions, and those made of links."""
    return [i for i in kept_places(lines) if not lines[i].level or lines[i].links]


def main_text(html: str, cut: Sequence[int] = ()) -> str:
    """The article's lines less those at the places of `cut`, joined by one space."""
    lines, gone = page_lines(html), set(cut)
    return " ".join(lines[i].text for i in kept_places(lines) if i not in gone)


def page_key(html_col: str):
    """Tells rows with equal ids apart by their html."""
    return F.xxhash64(text_or_empty(html_col))


def template_cuts(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(c_id, c_key, cut): places of lines that a page shares with its nearest page that is no copy, where differencing decides."""
    kind = pages.schema[id_col].dataType
    url = text_or_empty(url_col)
    # One resource under several names: trailing slashes and .html do not make another page.
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"\.html?$", ""), r"/+$", "")
    rows = pages.select(
        F.col(id_col).alias("id"), page_key(html_col).alias("key"), host_of(url).alias("host"), path.alias("path"), text_or_empty(html_col).alias("html")
    )
    schema = T.StructType(
        [T.StructField("id", kind)] + [T.StructField(n, t) for n, t in (
            ("key", T.LongType()), ("host", T.StringType()), ("path", T.StringType()),
            ("lines", T.ArrayType(T.LongType())), ("sizes", T.ArrayType(T.IntegerType())), ("open", T.ArrayType(T.IntegerType())), ("bare", T.BooleanType()))]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4, SLICE_BYTES):
            hashes, sizes, places, bare = [], [], [], []
            for html in batch.column(4).to_pylist():
                lines = page_lines(html)
                hashes.append([xxhash.xxh64_intdigest(line.text.encode("utf-8", "replace")) - 2**63 for line in lines])
                sizes.append([len(line.text) for line in lines])
                places.append(open_places(lines))
                bare.append(any(not lines[i].links for i in places[-1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())),
                 pa.array(places, pa.list_(pa.int32())), pa.array(bare, pa.bool_())], names=schema.names,
            )

    parsed = materialised(rows.mapInArrow(parse, schema), "page-lines")
    # One page stands for each path of a host; positions order them by path, whatever the size of a host.
    pick = F.struct(F.col("id").isNull().alias("none"), "id", "key", "lines", "sizes", "bare")
    stand = parsed.filter("host != ''").groupBy("host", "path").agg(F.min(pick).alias("page")).select("host", "path", "page.lines", "page.sizes", "page.bare")
    stand = global_positions(stand, [F.col("host"), F.col("path")], "at")
    stand = materialised(stand, "page-order")
    before, after = (
        stand.select(*[F.col(c).alias(f"{p}{i}") for c, p in (("at", "p_at"), ("host", "host"), ("path", "path"), ("lines", "lines"), ("sizes", "sizes"))])
        for i in (0, 1)
    )
    around = stand.select("at", F.col("path").alias("a_path")).join(copy_runs(stand).withColumnRenamed("host", "a_host"), "at")
    around = around.join(before, (F.col("at0") == F.col("p_at0")) & (F.col("a_host") == F.col("host0")), "left")
    around = around.join(after, (F.col("at1") == F.col("p_at1")) & (F.col("a_host") == F.col("host1")), "left")
    around = around.select("a_host", "a_path", "path0", "lines0", "sizes0", "path1", "lines1", "sizes1")
    undecided = parsed.filter(F.size("open") > 0)
    paired = undecided.join(around, (F.col("host") == F.col("a_host")) & (F.col("path") == F.col("a_path")))
    paired = paired.select("id", "key", "path", "open", "bare", "lines", "sizes", "path0", "lines0", "sizes0", "path1", "lines1", "sizes1")
    cuts = T.StructType(
        [T.StructField("c_id", kind), T.StructField("c_key", T.LongType()), T.StructField("cut", T.ArrayType(T.IntegerType()))]
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, path, open_lines, bare, lines, sizes, *sides in zip(*[c.to_pylist() for c in batch.columns]):
                sides = [(len(commonprefix([path, p])), q, n) for p, q, n in (sides[:3], sides[3:]) if q is not None]
                sides = [side for side in sides if not (bare and are_copies(lines, sizes, *side[1:]))]
                # The earlier page wins a tie.
                nearest = max(sides, key=lambda side: side[0])[1] if sides else []
                shared = set(shared_places(lines, nearest))
                found.append([i for i in open_lines if i in shared])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=cuts.names)

    # Rows that repeat id and html have equal cuts.
    return paired.mapInArrow(align, cuts).filter(F.size("cut") > 0).dropDuplicates(["c_id", "c_key"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars.

    The text is the article's lines in page order, joined by one space, with
    character references decoded and white space inside a line as one space.
    A null or empty html gives an empty text. A page without host, or alone on
    its host, has no partner and loses only what structure marks; so does a
    page without a marked region if its host holds nothing but copies of it. Repeated rows
    get equal texts; other columns are not read; an empty table gives no rows.
    """
    cuts = materialised(template_cuts(pages, id_col, url_col, html_col), "cuts")
    small = cuts.count() <= BROADCAST_ROWS
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"), page_key(html_col).alias("key")
    )
    match = rows["id"].eqNullSafe(cuts["c_id"]) & (rows["key"] == cuts["c_key"])
    rows = rows.join(F.broadcast(cuts) if small else cuts, match, "left").select("id", "url", "html", "cut")
    schema = T.StructType(
        [T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", pages.schema[url_col].dataType), T.StructField("text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, SLICE_BYTES):
            texts = [main_text(html, cut or ()) for html, cut in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars")
    )
