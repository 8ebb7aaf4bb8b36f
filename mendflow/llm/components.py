"""Connected components of a graph given as pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendflow.sources.tables import cut_lineage


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of the pairs (a, b).

    Each round links every node to the least of its neighbours, first from larger nodes, then among
    smaller ones, until only stars are left; depth halves at least every other round. Minima are
    pre-aggregated and joined back, so a node with many neighbours is never gathered. Pairs of a
    node with itself are ignored; repeated pairs count once; without pairs there are no rows.
    """
    edges = cut_lineage(
        pairs.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut_lineage(
            both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
