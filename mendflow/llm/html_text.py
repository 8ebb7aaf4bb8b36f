"""Main text of web pages by differencing against the page with the nearest URL.

Each page is cut into lines, the text between block-level tags. Within each host pages are ordered
by URL path, and a page is paired with the neighbour in that order whose path shares the longer
prefix. Lines outside the article that both pages have, aligned by longest common subsequence,
are the site's template and are deleted, as are those inside menus, headers, footers, sidebars,
notices, adverts, forms and comments, known by element, role or class. Lines of an ``article`` or
``main`` element are the page's own even if another page repeats them. A page consists of these and
of what differencing leaves outside, such as a lead above the article or more text below it.

Positions in the order come from a range sort of one light row for each path, so no host is
gathered; then pages meet their neighbour's line hashes by an equi-join whose hot keys Spark
splits. Both passes over the pages parse one page at a time.

A null url, or one without ``://``, has the empty host and path. Null html gives an empty text.
Pages of the same host and path share a neighbour, which never is one of them. Repeated rows are
all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.sources.tables import cut_lineage

ARTICLE, OTHER, CHROME = 0, 1, 2

_RAW = "script|style|noscript|template|textarea|iframe|svg|math|title|object|canvas|select|option"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+[^>]*+)(?:>|\Z)"""
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BREAKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end with their parent and that others needn't close.
_LOOSE = frozenset("b i u em strong a small big font code tt s strike sub sup mark q cite abbr label".split())
_CHROME_TAGS = frozenset("head nav header footer aside form menu button dialog search label fieldset".split())
_CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
_CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner "
    "cookie cookies consent notice notices alert alerts popup modal overlay sidebar aside menu menus nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer comment comments disqus reply replies respond related "
    "share sharing social newsletter subscribe subscription signup login search pagination pager toolbar widget "
    "widgets copyright".split()
)
_ABOUT = frozenset("has have no not with without is show hide after before".split())
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


@lru_cache(maxsize=4096)
def _is_chrome(tag: str, attributes: str) -> bool:
    if tag in _CHROME_TAGS:
        return True
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in _CHROME_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


@lru_cache(maxsize=4096)
def _is_named_chrome(tag: str, attributes: str) -> bool:
    """Whether a whole class name or id, or the last word of one, is that of chrome.

    Names such as ``has-sidebar`` or ``no-header`` tell of a page, not of what the element is.
    """
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for own in value.strip("\"'").lower().split():
                parts = re.split(r"[_-]+", own)
                if parts[-1] in _CHROME_NAMES and parts[0] not in _ABOUT:
                    return True
    return False


def lines_of(page: str) -> list[tuple[str, int]]:
    """The lines of a page, white space collapsed, with the zone of each."""
    out: list[tuple[str, int]] = []
    buffer: list[str] = []
    # Tag, whether it is chrome, whether it is the article, whether it is chrome by its name alone.
    stack: list[tuple[str, bool, bool, bool]] = []
    chrome = article = 0
    found = False

    def zone() -> int:
        return CHROME if chrome else ARTICLE if article else OTHER

    def flush(at: int) -> None:
        text = "".join(buffer)
        buffer.clear()
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            out.append((text, at))

    def pop() -> None:
        nonlocal chrome, article
        _, c, a, _ = stack.pop()
        chrome, article = chrome - c, article - a

    def inside(mark: int, now: int) -> None:
        # An inline element that changes the zone cuts the line; others leave it whole.
        if mark != now:
            flush(mark)

    last = 0
    for m in _TOKEN.finditer(page):
        if m.start() > last:
            buffer.append(page[last : m.start()])
        last = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, before = tag.lower(), zone()
        if tag in _BREAKS:
            flush(before)
            if not m["end"] and stack and stack[-1][0] == "p":
                pop()
        if m["end"]:
            if any(s[0] == tag for s in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif tag not in _VOID and not m["attributes"].rstrip().endswith("/"):
            sure = _is_chrome(tag, m["attributes"])
            c = sure or _is_named_chrome(tag, m["attributes"])
            a = tag in ("article", "main")
            if a and not found:
                # What holds the page's first article is no chrome, whatever it is called.
                for i, (t, old, of, named) in enumerate(stack):
                    if named:
                        stack[i] = (t, False, of, False)
                        chrome -= old
                found = not chrome
            if c or not (tag == "p" or tag in _LOOSE):
                stack.append((tag, c, a, c and not sure))
                chrome, article = chrome + c, article + a
        inside(before, zone())
    buffer.append(page[last:])
    flush(zone())
    return out


def _prefix_lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Length of the longest common subsequence of each prefix of ``a`` with ``b``."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = v = (1 << len(a)) - 1
    for y in b:
        u = v & where.get(y, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.frombuffer(v.to_bytes(len(a) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(bits, bitorder="little")[: len(a)].astype(np.int64))])


def common(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Indices in ``a`` of a longest common subsequence with ``b``, in linear memory."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    own = list(range(head)) + list(range(len(a) - tail, len(a)))
    if x and y:
        if len(y) == 1:
            inner = [x.index(y[0])] if y[0] in x else []
        else:
            half = len(y) // 2
            split = _prefix_lengths(x, y[:half]) + _prefix_lengths(x[::-1], y[half:][::-1])[::-1]
            k = int(split.argmax())
            inner = common(x[:k], y[:half]) + [k + i for i in common(x[k:], y[half:])]
        own += [head + i for i in inner]
    return sorted(own)


def _outside(lines: list[tuple[str, int]]) -> tuple[list[int], list[int]]:
    """Numbers and hashes of the lines outside the article."""
    at = [i for i, (_, zone) in enumerate(lines) if zone != ARTICLE]
    return at, [xxhash.xxh3_64_intdigest(lines[i][0]) - 2**63 for i in at]


def main_text(page: str, neighbour: Sequence[int]) -> str:
    """The text of a page, given the hashes of its neighbour's lines outside the article."""
    lines = lines_of(page)
    gone = {i for i, (_, zone) in enumerate(lines) if zone == CHROME}
    at, hashes = _outside(lines)
    gone |= {at[i] for i in common(hashes, list(neighbour))}
    return " ".join(text for i, (text, _) in enumerate(lines) if i not in gone)


def _strings(column: pa.Array) -> Iterator[str]:
    for x in column:
        yield x.as_py() or ""


_OUTSIDE = "host string, path string, outside array<long>"


def _outsides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_outside(lines_of(page))[1] for page in _strings(batch.column(2))]
        columns = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "outside"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def common_prefix(a: str, b: str | None) -> int:
        return -1 if b is None else next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for batch in batches:
        texts = []
        rest = [batch.column(i) for i in range(2, 8)]
        for page, path, before, before_lines, after, after_lines in zip(*rest, strict=True):
            path, before, after = path.as_py(), before.as_py(), after.as_py()
            nearer = before_lines if common_prefix(path, before) >= common_prefix(path, after) else after_lines
            texts.append(main_text(page.as_py() or "", nearer.as_py() or []))
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def host_and_path(url: str) -> list[Column]:
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.substr(u, F.locate("://", u) + 3)).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [
        F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, upper.lower()).alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"),
    ]


def _neighbours(pages: DataFrame) -> DataFrame:
    """For each host and path the paths before and after it and their lines outside the article."""
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = (
        pages.select(*host_and_path("url"), "html")
        .mapInArrow(_outsides, _OUTSIDE)
        .groupBy("host", "path")
        .agg(F.min("outside").alias("outside"))
    )
    # Position in the order: the rows of the partitions before, plus the row's own in its partition.
    placed = cut_lineage(
        one.repartitionByRange(n, "host", "path")
        .sortWithinPartitions("host", "path")
        .select("host", "path", "outside", F.monotonically_increasing_id().alias("id"))
        .withColumns({"part": F.shiftright("id", 33), "row": F.col("id").bitwiseAND(2**33 - 1)})
    )
    sizes = placed.groupBy("part").count()  # one row for each partition
    starts = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("start"))
    order = placed.join(F.broadcast(starts), "part").select(
        "host", "path", "outside", (F.col("start") + F.col("row")).alias("at")
    )

    def moved(by: int, name: str) -> DataFrame:
        return order.select(
            "host",
            (F.col("at") + by).alias("at"),
            F.col("path").alias(name),
            F.col("outside").alias(f"{name}_lines"),
        )

    return (
        order.drop("outside")
        .join(moved(1, "before"), ["host", "at"], "left")
        .join(moved(-1, "after"), ["host", "at"], "left")
        .drop("at")
    )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of ``pages`` (``page_id``, ``url``, ``html``)."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", *host_and_path("url"))
    return (
        own.join(cut_lineage(_neighbours(pages)), ["host", "path"], "left")
        .select("page_id", "url", "html", "path", "before", "before_lines", "after", "after_lines")
        .mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
    )
