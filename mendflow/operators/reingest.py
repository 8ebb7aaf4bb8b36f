"""Patch, re-validate, stage and merge repaired rows into the clean table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators.checks import Check, Evaluated, parse_checks
from mendflow.operators.lookup import (
    any_null,
    counted_join,
    distinct_hinted,
    is_small,
    lookup_join,
    matching_keys,
    split_by_keys,
)


def reingest_target(quarantine: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether quarantined rows can be merged back, where to and on which keys.

    One row, or one per ``by`` group. Only minima and maxima are kept per group, so the result
    is exact without gathering values.
    """
    source = F.when(F.col(S.DATA_SOURCE) != "", F.col(S.DATA_SOURCE))
    facts = quarantine.groupBy(*by).agg(
        F.min(source).alias("s1"),
        F.max(source).alias("s2"),
        F.min(S.ROW_ID_KEYS).alias("k1"),
        F.max(S.ROW_ID_KEYS).alias("k2"),
        F.coalesce(F.bool_or(S.IS_CROSS_TABLE), F.lit(False)).alias("cross"),
    )
    keys = F.filter(
        F.transform(F.split(F.coalesce("k1", F.lit("")), ","), lambda k: F.trim(k)), lambda k: k != ""
    )
    no_key = F.col("k1").isNull() | (F.col("k1") != F.col("k2")) | (F.size(keys) == 0)
    reason = (
        F.when(F.col("cross"), "cross_table_quarantine")
        .when(F.col("s1").isNull(), "no_data_source")
        .when(F.col("s1") != F.col("s2"), "ambiguous_data_source")
        .when(no_key, "no_business_key_for_merge")
    )
    return facts.select(
        *by,
        reason.isNull().alias("reingestable"),
        F.when(F.col("s1") == F.col("s2"), F.col("s1")).alias("silver_fqn"),
        keys.alias("merge_keys"),
        reason.alias("reason"),
    )


def _typed(text: Column, kind: str) -> Column:
    """Text as a column's type; null if it does not read as one."""
    if kind == "variant":
        return F.try_parse_json(text)
    if kind.startswith(("array<", "map<", "struct<")):
        opening = "[" if kind.startswith("array<") else "{"
        whole = F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith(opening)
        return F.when(whole, F.from_json(text, kind))
    return text.try_cast(kind)


def apply_patch(df: DataFrame, fix_col: str = "proposed_fix", columns: Sequence[str] | None = None) -> DataFrame:
    """Patch each data column named in the fix, cast to its own type.

    Presence of the key decides, so an explicit null patches. Arrays, maps and structs are read as
    JSON. A value that does not cast keeps the old value and sets ``_cast_failed``.
    """
    types = dict(df.dtypes)
    columns = list(columns or [c for c in S.data_columns(df) if c != fix_col])
    patched, failed = {}, F.lit(False)
    for c in columns:
        named = F.coalesce(F.map_contains_key(fix_col, F.lit(c)), F.lit(False))
        text = F.element_at(fix_col, F.lit(c))
        value = _typed(text, types[c])
        broken = named & text.isNotNull() & value.isNull()
        patched[c] = F.when(named & ~broken, value).otherwise(F.col(c))
        failed = failed | broken
    return df.withColumns({**patched, "_cast_failed": failed})


def revalidate(
    candidates: DataFrame,
    checks: Sequence[Mapping],
    refs: Mapping[str, DataFrame] | None = None,
    against: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Every candidate with ``passed``; pass means no failed error check and no failed cast.

    ``candidates`` has ``row_id`` and the data columns. With ``against`` the uniqueness checks
    also see the target rows whose key no candidate is about to replace.
    """
    columns = S.data_columns(candidates)
    parsed = parse_checks(checks)
    markers = ["__cast_failed", "__candidate"]
    cast_failed = F.col("_cast_failed") if "_cast_failed" in candidates.columns else F.lit(False)
    rows = candidates.select(
        *columns, "row_id", cast_failed.alias(markers[0]), F.lit(True).alias(markers[1])
    )
    union = rows
    unique = [c for c in parsed if c.function == "is_unique"]
    if against is not None and unique:
        small = is_small(rows.select(*{*keys, *(c for u in unique for c in u.columns)}))
        replaced = distinct_hinted(rows.select(*keys), small)
        kept = against.join(replaced, list(keys), "left_anti")
        for check in unique:
            union = union.unionByName(_colliding(kept, rows, check, small))
    done = Evaluated(union, parsed, refs, markers)
    passed = ~done.any_failing("error") & ~F.col("__cast_failed")
    return done.frame.filter("__candidate").select(
        "row_id", *columns, passed.alias("passed"), done.results("error").alias(S.ERROR)
    )


def _colliding(target: DataFrame, rows: DataFrame, check: Check, small: bool) -> DataFrame:
    """Distinct target values of a uniqueness key that some candidate also has.

    The target is cut by a semi join with the candidates' values before anything is counted.
    """
    folded = set(check.arguments.get("ci_columns") or [])
    same_nulls = not check.arguments.get("nulls_distinct", True)

    def value(c: str) -> Column:
        return F.lower(c) if c in folded else F.col(c)

    wanted = distinct_hinted(
        rows.select(*[value(c).alias(f"__w_{c}") for c in check.columns]), small
    )
    pairs = [
        value(c).eqNullSafe(F.col(f"__w_{c}")) if same_nulls else value(c) == F.col(f"__w_{c}")
        for c in check.columns
    ]
    hits = target.select(*check.columns).join(
        wanted, reduce(lambda a, b: a & b, pairs), "left_semi"
    ).distinct()
    marks = {"__cast_failed": F.lit(False), "__candidate": F.lit(False)}
    return hits.select(
        *[
            marks[f.name]
            if f.name in marks
            else (F.col(f.name) if f.name in check.columns else F.lit(None)).cast(f.dataType)
            for f in rows.schema
        ]
    ).toDF(*rows.columns)


def stage(candidates: DataFrame, queue: DataFrame) -> DataFrame:
    """Passing candidates with their confidence and whether a proposal repaired them."""
    origin = queue.select(
        "row_id",
        "confidence",
        (F.col("remediation_source") == "agent").alias("agent_curated"),
    )
    return candidates.filter("passed").drop("passed", S.ERROR).join(origin, "row_id")


def with_lineage(staged: DataFrame, run_id: str, as_of: Column | None = None) -> DataFrame:
    """Add the lineage columns the clean table may carry."""
    return staged.withColumns(
        {
            "confidence": F.col("confidence").cast("double"),
            "reingest_run_id": F.lit(run_id),
            "reingested_at": F.current_timestamp() if as_of is None else as_of,
        }
    )


def align_to_target(
    staged: DataFrame, target: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Staged rows cut to the target's columns, and the names that were dropped."""
    common = [c for c in staged.columns if c in target.columns]
    absent = [k for k in keys if k not in common]
    if absent:
        raise ValueError(f"merge keys are not columns of the target: {absent}")
    dropped = [c for c in staged.columns if c not in common and c != "row_id"]
    return staged.select(*common), dropped


def null_key_rows(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows whose business key has a null; they can never match and must escalate."""
    return staged.filter(any_null(keys))


def repeated_key_rows(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows that share their business key with another one; no one of them can be merged."""
    return mark_repeated_keys(staged, keys).filter("__repeated").drop("__repeated")


def mark_repeated_keys(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``__repeated``: whether another row has the same business key. Keys with a null do not repeat.

    Only repeated keys are joined back, spread if they are heavy.
    """
    counts = (
        staged.filter(~any_null(keys)).groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1")
    )
    flagged = counts.select(*keys, F.lit(True).alias("__repeated"))
    return counted_join(staged, flagged, counts, keys).withColumn(
        "__repeated", F.coalesce("__repeated", F.lit(False))
    )


def judge(checked: DataFrame, keys: Sequence[str], merged: str) -> DataFrame:
    """Re-validated rows with their ``outcome``: ``fail``, ``not_mergeable`` or ``merged``.

    A passing row escalates when its business key has a null, or when a fix gave it the key of
    another passing row. The real run and the dry run both decide with this.
    """
    passing = checked.filter("passed").select("row_id", *keys)
    marks = mark_repeated_keys(passing, keys).select("row_id", "__repeated")
    outcome = (
        F.when(~F.col("passed"), "fail")
        .when(any_null(keys) | F.coalesce("__repeated", F.lit(False)), "not_mergeable")
        .otherwise(merged)
    )
    return checked.join(marks, "row_id", "left").withColumn("outcome", outcome).drop("__repeated")


def touched_partitions(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], parts: Sequence[str]
) -> DataFrame:
    """Distinct partitions of the target that a merge changes: where rows are, and where they go."""
    known = distinct_hinted(staged.select(*keys))
    old = target.join(known, list(keys), "left_semi").select(*parts)
    types = dict(target.dtypes)
    new = staged.select(
        *[(F.col(p) if p in staged.columns else F.lit(None)).cast(types[p]).alias(p) for p in parts]
    )
    return old.unionByName(new).distinct()


def in_partitions(target: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The target's rows in the given partitions; Spark prunes the scan by them."""
    marks = touched.select(*[F.col(p).alias(f"__p_{p}") for p in parts])
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"__p_{p}")) for p in parts])
    return target.join(marks, same, "left_semi")


def merge_split(
    staged: DataFrame, target: DataFrame, keys: Sequence[str], small: bool | None = None
) -> DataFrame:
    """Staged rows with ``merge_action`` ``insert`` or ``update``."""
    known = matching_keys(target, staged, keys, small).withColumn("__known", F.lit(True))
    return (
        staged.join(known, list(keys), "left")
        .withColumn("merge_action", F.when(F.col("__known"), "update").otherwise("insert"))
        .select(*staged.columns, "merge_action")
    )


def merge_counts(split: DataFrame) -> DataFrame:
    return split.agg(
        F.count_if(F.col("merge_action") == "insert").alias("would_insert"),
        F.count_if(F.col("merge_action") == "update").alias("would_update"),
    )


def merge_upsert(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], small: bool | None = None
) -> DataFrame:
    """The target after the merge: matched rows take the staged values, others are added.

    Target columns the staged rows lack stay as they are. Target rows may repeat a key or hold
    nulls in it; staged rows are unique per key, which ``judge`` sees to. Without non-key columns
    only inserts happen. The staged rows are measured once; a small batch is sent to the target's
    tasks, which then is not shuffled. Of a large one the target's tasks get the range and a bitmap of
    the keys, and only target rows that may match are shuffled.
    """
    keys = list(keys)
    common = [c for c in staged.columns if c in target.columns]
    values = [c for c in common if c not in keys]
    source = staged.select(*common).filter(~any_null(keys))
    small = is_small(source) if small is None else small
    never = None
    if not small:
        target, never = split_by_keys(target, source, keys)
    kept = target
    if values:
        renamed = source.select(
            *keys, *[F.col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__hit")
        )
        types = dict(target.dtypes)
        joined = target.join(F.broadcast(renamed), keys, "left") if small else lookup_join(target, renamed, keys)
        kept = joined.select(
            *[
                F.when(F.col("__hit"), F.col(f"__new_{c}").cast(types[c])).otherwise(F.col(c)).alias(c)
                if c in values
                else F.col(c)
                for c in target.columns
            ]
        )
    added = source.join(matching_keys(target, source, keys, small), keys, "left_anti")
    aligned = added.select(
        *[
            (F.col(f.name) if f.name in common else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )
    merged = kept.unionByName(aligned)
    return merged if never is None else merged.unionByName(never)


def merge_sql(target: str, source: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """``MERGE INTO`` text for table formats that execute it."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    values = [c for c in columns if c not in keys]
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in values)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if values else ""
    names = ", ".join(f"`{c}`" for c in columns)
    inserts = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {target} AS t USING {source} AS s ON {on} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({inserts})"
    )
