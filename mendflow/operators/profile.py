"""Profiles of failing values that can be added up: by day, by table or by run.

For each signature and column a profile keeps a number of rows, sketches of the commonest value shapes, of
the number of distinct values and of the quantiles of numbers. Two profiles of different rows are
merged without the rows, so a profile over all time costs one merge a batch. Sketches are Spark's own;
what they tell is exact while a group has fewer shapes, values and numbers than they track.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions.transforms import column, quoted
from mendflow.operators.induce import shape_of

#: Shapes tracked for each group, bits of the distinct counter, accuracy of the quantiles.
TRACKED, DISTINCT_BITS, QUANTILE_K = 1000, 14, 400


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row for each ``signature`` and column: ``n_rows``, ``n_nulls`` and its sketches."""
    columns = list(columns) if columns is not None else S.data_columns(df.drop("signature"))
    listed = ", ".join(f"named_struct('column', {quoted(c)}, 'value', CAST({column(c)} AS string))" for c in columns)
    pairs = df.select("signature", F.expr(f"inline(array({listed}))"))
    sketches = pairs.withColumns({"shape": shape_of(F.col("value")), "number": F.expr("try_cast(value AS double)")})
    return sketches.groupBy("signature", "column").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_nulls"),
        F.expr(f"approx_top_k_accumulate(shape, {TRACKED})").alias("shapes"),
        F.expr(f"hll_sketch_agg(value, {DISTINCT_BITS})").alias("distinct"),
        F.expr(f"kll_sketch_agg_double(number, {QUANTILE_K})").alias("quantiles"),
    )


def merge_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """One profile of all rows of several profiles."""
    together = reduce(lambda a, b: a.unionByName(b), profiles)
    return together.groupBy("signature", "column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.expr(f"approx_top_k_combine(shapes, {TRACKED})").alias("shapes"),
        F.expr("hll_union_agg(distinct)").alias("distinct"),
        F.expr(f"kll_merge_agg_double(quantiles, {QUANTILE_K})").alias("quantiles"),
    )


def read_profile(profiles: DataFrame, shapes: int = 5, ranks: Sequence[float] = (0.0, 0.5, 1.0)) -> DataFrame:
    """What a profile tells: distinct values, the commonest shapes with their rows, quantiles of numbers."""
    listed = ", ".join(f"{float(r)}D" for r in ranks)
    found = profiles.withColumn("top", F.expr(f"approx_top_k_estimate(shapes, {shapes})"))
    ordered = F.array_sort(
        F.transform(F.filter("top", lambda t: t["item"].isNotNull()), lambda t: F.struct((-t["count"]).alias("n"), t["item"].alias("shape")))
    )
    numbers = F.expr("kll_sketch_get_n_double(quantiles)")
    return found.select(
        "signature",
        "column",
        "n_rows",
        "n_nulls",
        F.expr("hll_sketch_estimate(distinct)").alias("n_distinct"),
        F.transform(ordered, lambda t: F.struct(t["shape"].alias("shape"), (-t["n"]).alias("n_rows"))).alias("shapes"),
        F.when(numbers > 0, F.expr(f"kll_sketch_get_quantile_double(quantiles, array({listed}))")).alias("quantiles"),
    )
