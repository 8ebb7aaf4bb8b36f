"""All checks of a table that look at keys, decided by one count of keys.

Every row gives one key for each check (uniqueness, foreign key, comparison with another table),
the keys of the other tables and of earlier batches join them, and one aggregation over
(check, key digest) decides all checks: one exchange however many checks there are. The failing keys
are written once and measured; few of a check's, the usual case, are sent to the rows' tasks, and
many are joined with the heavy keys spread. Keys are compared by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

from mendflow.operators import lookup
from mendflow.sources import tables

#: Bytes of one failing key of which all tasks get a copy.
FLAGGED_BYTES = 48


def digest(columns: Sequence[Column]) -> list[Column]:
    """Two independent hashes of a key."""
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("second"), *columns).alias("k2")]


def plain(value: Column, of: DataType) -> Column:
    """Zero has one sign, so that equal numbers hash alike."""
    return F.when(value == 0, F.lit(0.0).cast(of)).otherwise(value) if isinstance(of, (FloatType, DoubleType)) else value


def kind(df: DataFrame, name: str) -> DataType:
    """The type of a column or of a field of one."""
    return df.schema[name].dataType if name in df.columns else df.select(name).schema[0].dataType


def unique_key(df: DataFrame, check) -> tuple[list[Column], bool]:
    """The compared columns of a uniqueness check, and whether a null makes a key distinct."""
    folded = set(check.arguments.get("ci_columns") or [])
    distinct_nulls = check.arguments.get("nulls_distinct", True)
    columns = [F.lower(c) if c in folded else plain(F.col(c), kind(df, c)) for c in check.columns]
    if not distinct_nulls:  # hashing skips a null, so its place is marked
        columns = [x for v in columns for x in (v.isNull(), v)]
    return columns, distinct_nulls


def _common(df: DataFrame, columns: Sequence[str], other: DataFrame, theirs: Sequence[str]) -> list[DataType]:
    """The types in which keys of two tables are compared."""
    both = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).limit(0).union(other.select(*theirs).limit(0))
    return [f.dataType for f in both.schema]


def unique_keys(df: DataFrame, check) -> DataFrame:
    """The key digest (``k1``, ``k2``) of every row that a uniqueness check looks at."""
    columns, distinct_nulls = unique_key(df, check)
    rows = df.filter(~lookup.any_null(check.columns)) if distinct_nulls else df
    return rows.select(*digest(columns))


class _Keyed:
    """One check: the key of a row, and the keys it is compared with."""

    def __init__(self, df: DataFrame, check, refs: Mapping):
        args, self.check, self.other, self.value = check.arguments, check, None, None
        rule = {"is_unique": self._unique, "foreign_key": self._foreign, "sql_query": self._compared}[check.function]
        rule(df, check, args, refs)

    def _unique(self, df, check, args, refs):
        columns, distinct_nulls = unique_key(df, check)
        self.usable = ~lookup.any_null(check.columns) if distinct_nulls else F.lit(True)
        self.key = digest(columns)
        self.fails = (F.col("n") > 0) & (F.col("n") + F.col("before") > 1)
        history = refs.get(args["history"]) if args.get("history") else None
        if args.get("history") and history is None:
            raise ValueError(f"check needs the key counts {args['history']!r}; pass them in refs")
        if history is not None:
            self.other = history.earlier(unique_keys(df, check)).select("k1", "k2", F.col("n").alias("before"))

    def _foreign(self, df, check, args, refs):
        other, theirs = ref(refs, args["ref_table"]), list(args.get("ref_columns") or [args["ref_column"]])
        types = _common(df, check.columns, other, theirs)
        self.usable = ~lookup.any_null(check.columns)
        self.key = digest([plain(F.col(c).cast(t), t) for c, t in zip(check.columns, types, strict=True)])
        known = [plain(F.col(c).cast(t), t) for c, t in zip(theirs, types, strict=True)]
        self.other = other.filter(~lookup.any_null(theirs)).select(*digest(known), F.lit(1).cast("long").alias("before"))
        self.fails = (F.col("n") > 0) & (F.col("before") == 0)

    def _compared(self, df, check, args, refs):
        other, keys = ref(refs, args["other_table"]), list(args["join_keys"])
        text = [F.col(k).cast("string") for k in keys]
        self.usable, self.key = ~lookup.any_null(keys), digest(text)
        self.value = F.col(args["compare_column"]).cast("string")
        theirs = F.lit(1).cast("long").alias("before")
        self.other = other.filter(~lookup.any_null(keys)).select(*digest(text), theirs, self.value.alias("value"))
        same = F.col("value").eqNullSafe(F.col("low")) & F.col("value").eqNullSafe(F.col("high"))
        some_null = (F.col("nulls") > 0) & F.col("value").isNotNull()
        self.fails = (F.col("n") > 0) & (F.col("before") > 0) & (~same | some_null)


def ref(refs: Mapping, name: str) -> DataFrame:
    if name not in refs:
        raise ValueError(f"check needs table {name!r}; pass it in refs")
    return refs[name]


def counted_keys(df: DataFrame, keyed: Sequence[_Keyed]) -> DataFrame:
    """For each check and key: rows here (``n``), rows elsewhere (``before``), and the values to compare."""
    values = any(k.value is not None for k in keyed)
    none = F.lit(None).cast("string")

    def entry(i: int, k: _Keyed) -> Column:
        value = [(none if k.value is None else k.value).alias("own")] if values else []
        return F.when(k.usable, F.struct(F.lit(i).alias("check"), *k.key, *value))

    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = df.select(F.explode(F.array_compact(F.array(*[entry(i, k) for i, k in enumerate(keyed)]))).alias("x")).select("x.*")
    rows = rows.withColumns({"n": one, "before": zero} | ({"value": none} if values else {}))
    for i, k in enumerate(keyed):
        if k.other is not None:
            other = k.other.withColumns({"check": F.lit(i), "n": zero} | ({"own": none} if values else {}))
            if values and "value" not in other.columns:
                other = other.withColumn("value", none)
            rows = rows.unionByName(other.select(*rows.columns))
    sums = [F.sum("n").alias("n"), F.sum("before").alias("before")]
    if values:
        nulls = F.count_if((F.col("n") > 0) & F.col("own").isNull())
        sums += [F.min("own").alias("low"), F.max("own").alias("high"), nulls.alias("nulls"), F.min("value").alias("value")]
    return rows.groupBy("check", "k1", "k2").agg(*sums)


def mark_failing(df: DataFrame, checks: Mapping[str, object], refs: Mapping) -> DataFrame:
    """``df`` with a boolean for each check, named by the mapping: whether the row fails it."""
    keyed = [_Keyed(df, c, refs) for c in checks.values()]
    fails = reduce(lambda a, b: a | b, [(F.col("check") == i) & k.fails for i, k in enumerate(keyed)])
    heavy = F.col("n") >= lookup.TASK_ROWS
    counted = counted_keys(df, keyed).withColumn("fails", F.coalesce(fails, F.lit(False))).filter(F.col("fails") | heavy)
    value = [F.col("value")] if any(k.value is not None for k in keyed) else []
    found = tables.cut_lineage(counted.select("check", "k1", "k2", "n", "fails", *value))
    width = F.sum(F.coalesce(F.octet_length(*value), F.lit(0))) if value else F.lit(0)
    # One row for each check.
    sizes = {
        r["check"]: (r["keys"], r["bytes"])
        for r in found.filter("fails").groupBy("check").agg(F.count("*").alias("keys"), width.alias("bytes")).collect()
    }
    for i, (k, hidden) in enumerate(zip(keyed, checks, strict=True)):
        keys, held = sizes.get(i, (0, 0))
        if not keys:
            df = df.withColumn(hidden, F.lit(False))
            continue
        on = [f"{hidden}_k1", f"{hidden}_k2"]
        own = found.filter(F.col("check") == i).select(
            F.col("k1").alias(on[0]), F.col("k2").alias(on[1]), F.col("n").alias("__n"), F.col("fails").alias(hidden),
            *[v.alias(f"{hidden}_v") for v in value],
        )
        flagged = own.filter(hidden).drop("__n")
        rows = df.withColumns({c: F.when(k.usable, x) for c, x in zip(on, k.key, strict=True)})
        if keys * FLAGGED_BYTES + held <= lookup.MAX_BROADCAST_BYTES:
            rows = rows.join(F.broadcast(flagged), on, "left")
        else:
            rows = lookup.counted_join(rows, flagged, own, on)
        failing = F.coalesce(F.col(hidden), F.lit(False))
        if k.value is not None:
            failing = failing & ~k.value.eqNullSafe(F.col(f"{hidden}_v"))
        df = rows.withColumn(hidden, failing).drop(*on, f"{hidden}_v")
    return df
