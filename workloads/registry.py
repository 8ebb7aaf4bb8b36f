"""Registry of queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its checking SQL if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def names(column: str) -> Column:
    """Names of a result array as text; empty when nothing failed."""
    found = F.coalesce(F.transform(column, lambda r: r["name"]), F.array().cast("array<string>"))
    return F.array_join(found, "|")


def joined(column: str | Column) -> Column:
    return F.array_join(column, "|")


def sorted_map(column: str | Column) -> Column:
    """A map as ``key=value`` text in key order; null values read ``<null>``."""
    entries = F.array_sort(F.map_entries(column))
    text = F.transform(
        entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("<null>")))
    )
    return F.array_join(text, ";")


def day(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
