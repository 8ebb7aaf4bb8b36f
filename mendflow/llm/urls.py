"""URL filters: a trie over reversed host labels and path segments, broadcast to the tasks.

An entry has a host and a path. It fits its host and all subdomains when the url's path starts
with the entry's. Of the entries that fit, the one with the longest host wins, then the longest
path; if the same entry is both allowed and blocked, it is blocked.

A node of the trie has children by host label, from the last label backwards; an entry's path hangs
below its last label, by segment, and its last segment, which may be a part of the url's, is looked
up among the ends of that node by its length. The trie is built on the driver from at most
``BLOCK_ENTRIES`` entries; a longer list is tried in blocks and the better match taken.

A null url, or one without ``://``, has an empty host and path, which no entry fits; unmatched
urls get the default verdict. Repeated rows are judged alike; other columns pass through, but for
those named like the four results, which are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of one broadcast trie, some 200 bytes each.
BLOCK_ENTRIES = 200_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def host_and_path(url: str | None) -> tuple[str, str]:
    begin = url.find("://") if url else -1
    if begin < 0:
        return "", ""
    rest = url[begin + 3 :]
    end = min(i for i in (rest.find("?"), rest.find("#"), len(rest)) if i >= 0)
    host, slash, path = rest[:end].partition("/")
    return host.translate(_LOWER), slash + path


def trie(entries: Iterable[tuple[str, str, bool, int]]) -> dict:
    """``entries``: host, path, whether it allows, number. A node: "hosts", "paths" and "ends"."""

    def node() -> dict:
        return {"hosts": {}, "paths": {}, "ends": {}}

    root = node()
    for host, path, allow, number in entries:
        at = root
        for label in reversed(host.split(".")) if host else ():
            at = at["hosts"].setdefault(label, node())
        at = at["paths"].setdefault("", node())  # a path begins with an empty segment
        *inner, last = path.split("/")[1:] if path else [None]
        for segment in inner:
            at = at["paths"].setdefault(segment, node())
        old = at["ends"].get(last)
        if old is None or not allow and old[1]:
            at["ends"][last] = (number, allow)
    return root


def match(root: dict, host: str, path: str) -> tuple[int, int, int, bool] | None:
    """Labels, path length, number and verdict of the longest entry that fits."""
    if not host:
        return None
    at, best, labels = root, None, 0
    for label in reversed(host.split(".")):
        at = at["hosts"].get(label)
        if at is None:
            break
        labels += 1
        best = _longest_path(at, labels, path) or best
    return best


def _longest_path(at: dict, labels: int, path: str) -> tuple[int, int, int, bool] | None:
    at = at["paths"].get("")
    if at is None:
        return None
    best = (labels, 0, *at["ends"][None]) if None in at["ends"] else None
    if not path.startswith("/"):
        return best
    length = 1
    for segment in path.split("/")[1:]:
        ends = at["ends"]
        for end in range(len(segment), -1, -1) if len(segment) < len(ends) else sorted(
            {len(e) for e in ends if e is not None}, reverse=True
        ):
            if end <= len(segment) and segment[:end] in ends:
                best = (labels, length + end, *ends[segment[:end]])
                break
        at = at["paths"].get(segment)
        if at is None:
            break
        length += len(segment) + 1
    return best


_FOUND = "host string, path string, labels int, length int, number int, allow boolean"


def _matcher(tried):
    @F.pandas_udf(_FOUND)
    def run(urls: pd.Series) -> pd.DataFrame:
        root, rows = tried.value, []
        for url in urls:
            host, path = host_and_path(url if isinstance(url, str) else None)
            rows.append((host, path, *(match(root, host, path) or (-1, -1, None, None))))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in _FOUND.split(", ")]).astype(
            {"number": "Int32", "allow": "boolean"}
        )

    return run


def filter_urls(
    pages: DataFrame,
    allow: Sequence[tuple[str, str]],
    block: Sequence[tuple[str, str]],
    default: str = "allow",
    url: str = "url",
) -> DataFrame:
    """``pages`` with host, path, rule (host and path of the entry that won, else null), verdict."""
    sc = pages.sparkSession.sparkContext
    listed = [(h, p, True) for h, p in allow] + [(h, p, False) for h, p in block]
    entries = [(h.translate(_LOWER), p, a, i) for i, (h, p, a) in enumerate(listed)]
    blocks = [entries[i : i + BLOCK_ENTRIES] for i in range(0, max(len(entries), 1), BLOCK_ENTRIES)]
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    names = [f"__found{i}" for i in range(len(blocks))]
    tried = pages.select(
        F.struct(*kept).alias("row"),
        *[_matcher(sc.broadcast(trie(b)))(F.col(url)).alias(n) for b, n in zip(blocks, names, strict=True)],
    )
    # More labels, then the longer path, then blocking; the names of the winners come from the list.
    ranked = [F.struct(f"{n}.labels", f"{n}.length", (~F.coalesce(f"{n}.allow", F.lit(True))).alias("b"), f"{n}.number") for n in names]
    best = ranked[0] if len(ranked) == 1 else F.greatest(*ranked)
    rule = functools.reduce(
        lambda c, x: c.when(F.col("best.number") == x[3], x[0] + x[1]), entries, F.when(F.lit(False), F.lit(None))
    ) if len(entries) <= 64 else _lookup(sc.broadcast([h + p for h, p, _, _ in entries]))(F.col("best.number"))
    verdict = F.when(F.col("best.number").isNull(), default).when(F.col("best.b"), "block").otherwise("allow")
    return tried.withColumn("best", best).select(
        "row.*",
        F.col(f"{names[0]}.host").alias("host"),
        F.col(f"{names[0]}.path").alias("path"),
        rule.cast("string").alias("rule"),
        verdict.alias("verdict"),
    )


def _lookup(listed):
    @F.pandas_udf("string")
    def run(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda i: None if pd.isna(i) else listed.value[int(i)])

    return run


#: The entries of the registered query.
ALLOW = [("com", "/"), ("www.example.com", "/en/")]
BLOCK = [("example.com", "/en/"), ("net", "/es/"), ("net", "/fr/")]

ORACLE = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
rules AS (
  SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) r(h, s, v))
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
  arg_max(h || s, length(h || s)) AS rule, coalesce(arg_max(v, length(h || s)), 'allow') AS verdict
FROM q LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
GROUP BY page_id
"""
