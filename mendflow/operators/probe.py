"""Cross-table probe: does normalising a column remove its mismatch with another table?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions.transforms import chain
from mendflow.operators.lookup import distinct_hinted, lookup_join
from mendflow.sources.playbooks import STANDARD_TRANSFORMS


def probe_scores(
    df: DataFrame,
    other: DataFrame,
    column: str,
    join_keys: Sequence[str],
    normalizations: Sequence[str] = ("trim", "lower_trim", "upper_trim"),
    sample_rows: int | None = None,
) -> DataFrame:
    """Per signature and normalisation: rows that joined and rows that then agree.

    Every row counts unless ``sample_rows`` asks for the first so many of each signature by
    ``row_id``. The other table is cut to the rows' keys before it is made unique, so its shuffle
    carries little.
    """
    keys = [f"__j{i}" for i in range(len(join_keys))]
    named = [F.col(k).cast("string").alias(j) for j, k in zip(keys, join_keys)]
    value = F.col(column).cast("string")
    first = Window.partitionBy("signature").orderBy("row_id")
    sample = df.select("signature", "row_id", *named, value.alias("__left"))
    if sample_rows is not None:
        sample = sample.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") <= sample_rows).drop("__rn")
    wanted = distinct_hinted(sample.select(*keys))
    partner = (
        other.select(*named, value.alias("__right"))
        .join(wanted, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.min("__right").alias("__right"))
    )
    used = [n for n in normalizations if n in STANDARD_TRANSFORMS]

    def agrees(name: str):
        left, right = (chain([{"transform": name}], c) for c in ("__left", "__right"))
        return F.count_if(left.eqNullSafe(right)).alias(f"__n_{name}")

    totals = (
        lookup_join(sample, partner.withColumn("__found", F.lit(True)), keys)
        .filter("__found")
        .groupBy("signature")
        .agg(F.count("*").alias("sampled"), *[agrees(n) for n in used])
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("rank"), F.lit(n).alias("normalization"), F.col(f"__n_{n}").alias("matched")
            )
            for i, n in enumerate(used)
        ]
    )
    return totals.select("signature", "sampled", F.inline(rows)).withColumn(
        "share", F.try_divide("matched", "sampled")
    )


def cross_table_probe(
    df: DataFrame,
    other: DataFrame,
    column: str,
    join_keys: Sequence[str],
    normalizations: Sequence[str] = ("trim", "lower_trim", "upper_trim"),
    sample_rows: int | None = None,
    threshold: float = S.PROBE_THRESHOLD,
) -> DataFrame:
    """Proposals per signature: the first normalisation that resolves enough, else escalate.

    Signatures without a joined row get no proposal and fall through to other proposers.
    """
    scores = probe_scores(df, other, column, join_keys, normalizations, sample_rows)
    winner = F.min(
        F.when(F.col("share") >= threshold, F.struct("rank", "normalization", "share"))
    )
    found = F.col("w").isNotNull()
    fix = F.array(
        F.create_map(F.lit("column"), F.lit(column), F.lit("transform"), F.col("w.normalization"))
    )
    return (
        scores.groupBy("signature")
        .agg(winner.alias("w"))
        .select(
            "signature",
            F.when(found, "fix").otherwise("escalate").alias("decision"),
            F.when(found, fix).otherwise(F.array().cast("array<map<string,string>>")).alias("fixes"),
            F.when(found, F.round(0.6 + 0.35 * F.col("w.share"), 2)).otherwise(0.85).alias("confidence"),
            F.when(found, F.concat(F.lit("cross-table probe: "), "w.normalization"))
            .otherwise("cross-table probe: no normalization resolved the mismatch")
            .alias("reasoning"),
        )
    )
