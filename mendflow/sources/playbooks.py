"""Playbook entries: reading them for a dataset and finding mistakes in them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mendflow.operators import lookup

# Priority of entries that name none, and the unfinished-entry marker.
DEFAULT_PRIORITY = 1_000_000
PLACEHOLDER = "REPLACE_ME"

# Parameters each strategy needs, and the transforms a patch may name.
STRATEGY_PARAMS = {
    "dedupe_keep_latest": ("partition_by", "order_by"),
    "standardize_value": ("column", "transform"),
    "fill_default": ("column", "default_expr"),
    "reject_rows": (),
}
STANDARD_TRANSFORMS = ("lower_trim", "trim", "upper_trim")

ENTRIES_DDL = (
    "dataset string, rule_name string, priority int, `where` string, strategy string, "
    "params map<string,string>, match_fqns array<string>"
)


def dataset_name(quarantine_fqn: str) -> str:
    """A playbook is named after the last segment of the quarantine table."""
    return quarantine_fqn.split(".")[-1]


def read_yaml(path: str) -> list[dict]:
    """Entries of one playbook file; a missing file means no entries."""
    import yaml

    try:
        with open(path) as handle:
            return (yaml.safe_load(handle) or {}).get("playbooks") or []
    except FileNotFoundError:
        return []


def by_priority(entries: Sequence[Mapping]) -> list[dict]:
    return sorted((dict(e) for e in entries), key=lambda e: e.get("priority", DEFAULT_PRIORITY))


def entries_frame(spark: SparkSession, entries: Mapping[str, Sequence[Mapping]]) -> DataFrame:
    """Entries of many datasets as one table; list parameters are stored as JSON text."""
    rows = []
    for dataset, listed in entries.items():
        for e in listed:
            params = {
                k: json.dumps(v) if isinstance(v, (list, tuple)) else str(v)
                for k, v in (e.get("params") or {}).items()
            }
            rows.append(
                (dataset, e.get("rule_name"), e.get("priority"), e.get("where"), e.get("strategy"),
                 params, e.get("match_fqns"))
            )
    return spark.createDataFrame(rows, ENTRIES_DDL)


def ranked_entries(entries_df: DataFrame) -> DataFrame:
    """All entries with their ``place`` in the order in which their dataset tries them; no priority comes last."""
    order = Window.partitionBy("dataset").orderBy(F.coalesce("priority", F.lit(DEFAULT_PRIORITY)), "rule_name")
    return entries_df.withColumn("place", F.row_number().over(order))


def playbook_entries(entries_df: DataFrame, dataset: str) -> list[dict]:
    """The entries of one dataset, in priority order."""
    rows = ranked_entries(entries_df.filter(F.col("dataset") == dataset)).orderBy("place").collect()
    found = []
    for r in rows:
        params = {}
        for k, v in (r["params"] or {}).items():
            params[k] = json.loads(v) if k in ("partition_by", "ci_columns") else v
        entry = {"rule_name": r["rule_name"], "strategy": r["strategy"], "params": params}
        for key in ("priority", "where", "match_fqns"):
            if r[key] is not None:
                entry[key] = r[key]
        found.append(entry)
    return found


def _param(name: str) -> Column:
    return F.element_at("params", F.lit(name))


def _listed(name: str) -> Column:
    return F.coalesce(
        F.from_json(_param(name), "array<string>"), F.array().cast("array<string>")
    )


def _mark_repeats(frame: DataFrame, mark: str, keys: list[str]) -> DataFrame:
    counts = (
        frame.filter(~lookup.any_null(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("__n"))
        .filter("__n > 1")
    )
    repeats = counts.select(*keys, F.lit(True).alias(mark))
    return lookup.counted_join(frame, repeats, counts, keys)


def lint_entries(entries_df: DataFrame, columns_df: DataFrame | None = None) -> DataFrame:
    """Problems of the entries of all datasets at once, one row per (entry, problem).

    ``columns_df`` has one row per ``(dataset, column_name)`` of the source tables.
    """
    strategy = F.col("strategy")
    problems = [
        F.when(F.trim(F.coalesce("rule_name", F.lit(""))) == "", "rule_name missing"),
        F.when(F.col("priority").isNull(), "priority missing"),
        F.when(
            ~F.coalesce(strategy.isin(list(STRATEGY_PARAMS)), F.lit(False)), "unknown strategy"
        ),
    ]
    for name, params in STRATEGY_PARAMS.items():
        for p in params:
            blank = F.coalesce(_param(p), F.lit("")).isin("", "[]")
            problems.append(F.when((strategy == name) & blank, f"{p} missing"))
    direction = F.lower(F.coalesce(_param("order_direction"), F.lit("desc")))
    outside = F.size(F.array_except(_listed("ci_columns"), _listed("partition_by"))) > 0
    problems += [
        F.when((strategy == "dedupe_keep_latest") & ~direction.isin("asc", "desc"), "bad order_direction"),
        F.when((strategy == "dedupe_keep_latest") & outside, "ci_columns outside partition_by"),
        F.when(
            (strategy == "standardize_value")
            & ~F.coalesce(_param("transform"), F.lit("")).isin("", *STANDARD_TRANSFORMS),
            "unknown transform",
        ),
    ]
    frame = _mark_repeats(entries_df, "__p", ["dataset", "priority"])
    frame = frame.withColumn("__where", F.coalesce("where", F.lit("")))
    frame = _mark_repeats(frame, "__r", ["dataset", "rule_name", "__where"])
    problems += [
        F.when(F.col("__p").isNotNull(), "duplicate priority"),
        F.when(F.col("__r").isNotNull(), "duplicate rule_name and where"),
    ]
    if columns_df is not None:
        known = columns_df.groupBy("dataset").agg(F.collect_set("column_name").alias("__known"))
        frame = frame.join(known, "dataset", "left")
        named = F.array_compact(
            F.concat(
                _listed("partition_by"),
                _listed("ci_columns"),
                F.array(_param("order_by"), _param("column")),
            )
        )
        absent = F.array_except(named, F.coalesce("__known", F.array().cast("array<string>")))
        problems.append(F.when(F.size(absent) > 0, "unknown column"))
    return (
        frame.withColumn("problem", F.explode(F.array_compact(F.array(*problems))))
        .select("dataset", "rule_name", "priority", "where", "strategy", "problem")
    )


def validate_playbook(entries_df: DataFrame, source: DataFrame, dataset: str | None = None) -> DataFrame:
    """Lint entries against one source table, including whether each ``where`` is a predicate.

    Only entries of ``dataset`` count if it is given. Each different ``where`` text is analysed
    once; nothing else of the entries comes to the driver.
    """
    entries = entries_df if dataset is None else entries_df.filter(F.col("dataset") == dataset)
    columns = entries.select("dataset").distinct().withColumn(
        "column_name", F.explode(F.array(*[F.lit(c) for c in source.columns]))
    )
    found = lint_entries(entries, columns)
    bad = []
    for (where,) in entries.filter(F.col("where").isNotNull()).select("where").distinct().collect():
        try:
            kind = source.select(F.expr(where).alias("w")).dtypes[0][1]
        except (AnalysisException, ParseException):
            kind = "invalid"
        if kind != "boolean":
            bad.append(where)
    if not bad:
        return found
    problem = F.lit("where is not a boolean expression").alias("problem")
    return found.unionByName(
        entries.filter(F.col("where").isin(bad)).select(
            "dataset", "rule_name", "priority", "where", "strategy", problem
        )
    )
