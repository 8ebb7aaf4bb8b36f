"""Joins that attach a lookup to rows whose keys may be badly skewed.

One key (or the null key) may hold a third of all rows. Spark's adaptive skew join helps when
it fires; these helpers do not depend on it. A key of more than ``TASK_ROWS`` rows is spread over
as many partitions as it has that number of rows, and only the lookup rows of such keys are
repeated; rows with a null key are spread too. Results stay exact whichever keys are found.

* ``lookup_join`` finds the heavy keys with a mergeable top-k sketch: one pass over the key
  columns that shuffles sketches, not keys. It runs when the plan is built. The sketch grows with
  the table, so that every key of more than a few tasks' rows is in it.
* ``counted_join`` is for checks that count their keys anyway: the heavy counted keys are
  broadcast as hash values, without an extra job.
* ``is_small`` measures a frame with one aggregation. Only a frame under
  ``MAX_BROADCAST_BYTES`` gets a broadcast hint; beyond that the join shuffles.
* ``class_join`` is for lookups with one row per failure class (few rows, huge groups): every
  lookup row is repeated for each shuffle partition.

Heavy keys are at most the table's rows over ``TASK_ROWS``, two numbers each.

The salt is the partition number of the row, so a recomputed task gives the same salt again
and exact copies of a row still spread out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow.sources import tables

#: Rows of one key that one task may get.
TASK_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Sketch size: least and most items, and items for each key that may be heavy.
TRACKED_KEYS = (4096, 1_000_000)
TRACKED_PER_HEAVY = 4
SKETCHES_A_TASK = 32


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _width(df: DataFrame) -> int:
    """Partitions to spread a group over that is known to be large."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _spread(salts: int | Column) -> Column:
    return F.pmod(F.spark_partition_id(), salts if isinstance(salts, Column) else F.lit(salts))


def _salted_join(df: DataFrame, lookup: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    """``hot`` has ``__hash`` and ``__salts`` of the heavy keys; it is small enough to send to all tasks."""
    nulls = -1 - _spread(_width(df))
    if hot is None:
        left = df.withColumn("__salt", F.when(any_null(on), nulls).otherwise(F.lit(0)).cast("int"))
        right = lookup.withColumn("__salt", F.lit(0))
        return left.join(right, [*on, "__salt"], "left").drop("__salt")
    hot = F.broadcast(hot)
    left, right = (x.withColumn("__hash", F.xxhash64(*on)).join(hot, "__hash", "left") for x in (df, lookup))
    salts = F.col("__salts")
    salt = F.when(any_null(on), nulls).when(salts > 1, _spread(salts)).otherwise(F.lit(0))
    left = left.withColumn("__salt", salt.cast("int")).drop("__hash", "__salts")
    copies = F.sequence(F.lit(0), F.coalesce(salts, F.lit(1)) - 1)
    right = right.withColumn("__salt", F.explode(copies)).drop("__hash", "__salts")
    return left.join(right, [*on, "__salt"], "left").drop("__salt")


def _salts(rows: str, task_rows: int) -> Column:
    return F.ceil(F.col(rows) / task_rows).cast("int")


def hot_keys(df: DataFrame, on: Sequence[str], task_rows: int | None = None) -> DataFrame | None:
    """``__hash`` and ``__salts`` of the heavy keys; keys with a null do not count.

    Sketches are merged in a tree, so that no task receives more than ``SKETCHES_A_TASK`` of them
    up to the third power of that number of input tasks.
    """
    task_rows = task_rows or TASK_ROWS
    keys = df.filter(~any_null(on)).select(F.xxhash64(*on).alias("h"))
    rows = keys.count()
    most = rows // task_rows
    if not most:
        return None
    tracked = min(max(TRACKED_PER_HEAVY * most, TRACKED_KEYS[0]), TRACKED_KEYS[1])
    sketches = keys.groupBy(F.spark_partition_id().alias("g")).agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"))
    for groups in (SKETCHES_A_TASK**2, SKETCHES_A_TASK, 1):  # a grouped merge skips partitions without a sketch
        step = sketches.groupBy(F.pmod("g", F.lit(groups)).alias("g"))
        sketches = step.agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    top = sketches.selectExpr(f"inline(approx_top_k_estimate(s, {min(most, tracked)}))")
    found = (
        top.filter(F.col("count") >= task_rows)
        .select(F.col("item").alias("__hash"), _salts("count", task_rows).alias("__salts"))
        .collect()
    )
    return df.sparkSession.createDataFrame(found, "__hash long, __salts int") if found else None


def is_small(df: DataFrame) -> bool:
    """Whether all rows together are under ``MAX_BROADCAST_BYTES``; runs one aggregation."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    row = reduce(lambda a, b: a + b, widths, F.lit(16 * len(widths))).cast("bigint")
    return (df.agg(F.sum(row)).head()[0] or 0) <= MAX_BROADCAST_BYTES


def distinct_hinted(df: DataFrame, small: bool | None = None) -> DataFrame:
    """Distinct rows, with a broadcast hint when ``df`` is measured to be small."""
    small = is_small(df) if small is None else small
    return F.broadcast(df.distinct()) if small else df.distinct()


def matching_keys(
    target: DataFrame, rows: DataFrame, on: Sequence[str], small: bool | None = None
) -> DataFrame:
    """Distinct keys of ``target`` that also occur in ``rows``.

    A few rows are sent to the target's tasks, so its keys are not shuffled; many rows meet the
    target's distinct keys.
    """
    on = list(on)
    wanted = rows.select(*on)
    if is_small(wanted) if small is None else small:
        return target.select(*on).join(distinct_hinted(wanted, True), on, "left_semi").distinct()
    return target.select(*on).distinct().join(wanted.distinct(), on, "left_semi")


#: Places of a key filter: 4096 pieces of 4 KB at most, however many keys there are.
FILTER_BITS = 27


def split_by_keys(
    target: DataFrame, rows: DataFrame, on: Sequence[str], bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """The target's rows whose key may be among those of ``rows``, and those whose key cannot be.

    The least and greatest key reach the target's scan; within them a bitmap of key hashes, of a
    fixed size, is sent to all tasks. So only rows that may match are left for a shuffle. Keys with
    a null match nothing.
    """
    on = list(on)
    types = dict(target.dtypes)
    keys = rows.select(*[F.col(k).try_cast(types[k]).alias(k) for k in on]).filter(~any_null(on))
    ranged = [k for k in on if not types[k].startswith(("array", "struct", "map", "variant", "binary", "boolean"))]
    ends = keys.agg(*[f(k).alias(f"{n}_{i}") for i, k in enumerate(ranged) for n, f in (("a", F.min), ("b", F.max))]).head() if ranged else None
    inside = ~any_null(on)
    for i, k in enumerate(ranged):
        inside = inside & F.col(k).between(F.lit(ends[f"a_{i}"]).cast(types[k]), F.lit(ends[f"b_{i}"]).cast(types[k]))
    outside = ~F.coalesce(inside, F.lit(False))

    place = F.pmod(F.xxhash64(*on), F.lit(2**bits))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    maps = keys.groupBy(bucket.alias("__piece")).agg(F.bitmap_construct_agg(bit).alias("__map"))
    maps = tables.cut_lineage(maps)
    octet = F.conv(F.hex(F.substring("__map", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(octet.bitwiseAND(F.pow(F.lit(2), F.col("__bit") % 8).cast("int")) != 0, F.lit(False))

    def looked_up(frame: DataFrame) -> DataFrame:
        placed = frame.withColumns({"__piece": bucket, "__bit": bit})
        return placed.join(F.broadcast(maps), "__piece", "left").withColumn("__hit_bit", hit).select(*frame.columns, "__hit_bit")

    maybe = looked_up(target.filter(inside)).filter("__hit_bit").drop("__hit_bit")
    never = target.filter(outside).unionByName(looked_up(target.filter(inside)).filter("not __hit_bit").drop("__hit_bit"))
    return maybe, never


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    measure: bool = False,
    task_rows: int | None = None,
) -> DataFrame:
    """Left join ``df`` to a lookup that is unique on ``on``.

    With ``measure`` a lookup that proves small is broadcast and ``df`` is not shuffled at all.
    """
    on = list(on)
    if measure and is_small(lookup):
        return df.join(F.broadcast(lookup), on, "left")
    types = dict(df.dtypes)  # both sides must hash alike
    typed = lookup.withColumns({k: F.col(k).cast(types[k]) for k in on})
    return _salted_join(df, typed, on, hot_keys(df, on, task_rows))


def counted_join(
    df: DataFrame,
    flagged: DataFrame,
    counts: DataFrame,
    on: Sequence[str],
    task_rows: int | None = None,
) -> DataFrame:
    """Left join ``df`` to ``flagged``, given ``counts`` with the rows ``__n`` of each heavy key.

    Keys that are missing from ``counts`` must be light. Hot keys are known by hash on both
    sides, so what is broadcast does not grow with the width of the keys.
    """
    on = list(on)
    task_rows = task_rows or TASK_ROWS
    hot = (
        counts.filter(F.col("__n") >= task_rows)
        .groupBy(F.xxhash64(*on).alias("__hash"))
        .agg(F.max("__n").alias("__n"))
        .select("__hash", _salts("__n", task_rows).alias("__salts"))
    )
    return _salted_join(df, flagged, on, hot)


def class_join(
    df: DataFrame, classes: DataFrame, on: Sequence[str], salts: int | None = None, how: str = "left"
) -> DataFrame:
    """Join ``df`` to a lookup with one row per class, each class spread over ``salts`` partitions."""
    on = list(on)
    salts = salts or _width(df)
    right = classes.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    left = df.withColumn("__salt", _spread(salts).cast("int"))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def latest_per_row(
    df: DataFrame,
    key: str | Sequence[str] = "_row_id",
    order: str = "_generated_at",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Newest version of each row; equal times are settled by a hash of the other columns.

    The ``= 1`` filter sits directly on the window, so each task drops its losers before the
    shuffle and a key with many versions costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if ties is None:
        hashable = [
            c for c, t in df.dtypes if c not in keys and c != order and "map<" not in t and t != "variant"
        ]
        breakers = [F.xxhash64(*hashable)] if hashable else []
    else:
        breakers = [F.col(c) for c in ties]
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *breakers)
    return df.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")
