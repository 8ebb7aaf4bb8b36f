"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the output over its share of the input, both in characters.
Each document is repeated as often as the Poisson quantile at its own hash says: the digest of a
seed, the document's id and its text gives a uniform number, and the count is the first at which
the distribution reaches that number. Rates over ``PART`` are split into equal parts with a number
each, since a sum of Poisson counts is a Poisson count. The copies are dealt to partitions, and
ordered in them, by another digest, which shuffles all sources together.

Only expressions and joins are used. Each source's distribution is computed once, in a table of
one row a source that Spark broadcasts if it is small and else joins with hot sources split.

Weights are shares and need not add up to 1; sources without a weight get none, weights without a
source are left out. Without weights all sources get the same. A null source is a source of its
own. Null text counts as empty. Sources without any characters are repeated once. Identical rows
get identical counts. An empty table gives no rows. Other columns pass through; the added ones,
``copy`` and ``order_key``, replace any of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendflow.sources.tables import cut_lineage

SEED = "mix"
PART = 256.0


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _rates(docs: DataFrame, weights: dict[str | None, float] | None, total: float | None) -> DataFrame:
    """For each source: the parts its rate is split in, and one part's distribution function."""
    size = F.sum(F.length(F.coalesce("text", F.lit(""))).cast("double"))
    sums = cut_lineage(docs.groupBy("source").agg(size.alias("size")))
    weight = F.lit(1.0)
    if weights is not None:
        rows = [(k, float(v)) for k, v in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, "name string, weight double")
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("name")), "left")
        weight = F.coalesce("weight", F.lit(0.0))
    sums = sums.select("source", "size", weight.alias("weight"))
    ends = sums.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).head()
    all_size, all_weight = ends["size"] or 0.0, ends["weight"] or 1.0
    goal = float(total if total is not None else all_size)
    rate = F.when(F.col("size") > 0, F.col("weight") * F.lit(goal) / F.lit(all_weight) / F.col("size")).otherwise(1.0)
    split = sums.select("source", rate.alias("rate")).withColumn(
        "parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    )
    split = split.withColumn("part", F.col("rate") / F.col("parts"))
    # Beyond this count no 52-bit number is left.
    most = F.ceil(F.col("part") + 12 * F.sqrt("part") + 40).cast("int")
    none = F.exp(-F.col("part"))
    step = F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct(none.alias("p"), F.array(none).alias("cdf")),
        lambda a, k: F.struct(
            (a["p"] * F.col("part") / k).alias("p"),
            F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + a["p"] * F.col("part") / k).alias("cdf"),
        ),
        lambda a: a["cdf"],
    )
    return cut_lineage(split.select("source", "parts", step.alias("cdf")))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    total: float | None = None,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source``) repeated to the weights, in shuffled order.

    ``total`` is the size of the output in characters, the input's by default.
    """
    kept = [c for c in docs.columns if c not in ("copy", "order_key")]
    rates = _rates(docs, weights, total).withColumnRenamed("source", "name")
    name = F.concat_ws(
        "|",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.md5(F.coalesce("text", F.lit(""))),
    )
    rows = docs.select(F.struct(*kept).alias("row"), F.col("source").alias("own"), name.alias("id"))
    numbers = F.transform(
        F.sequence(F.lit(1), F.col("parts")),
        lambda i: _uniform(F.lit(seed), i.cast("string"), F.col("id")),
    )
    counts = F.aggregate(
        numbers, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: c < u))
    )
    copies = (
        rows.join(rates, F.col("own").eqNullSafe(F.col("name")))
        .select("row", "id", counts.alias("n"))
        .filter("n > 0")
        .select("row", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    )
    order = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col("copy").cast("string"), F.col("id"))), 1, 16)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        copies.select("row.*", F.col("copy"), order.alias("order_key"))
        .repartition(n, "order_key")
        .sortWithinPartitions("order_key")
    )


#: Without weights, for rates up to ``PART``; ``{docs}`` is the table.
ORACLE = """
WITH RECURSIVE sums AS (
  SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size FROM {docs} GROUP BY 1),
ends AS (SELECT sum(size) AS size, CAST(count(*) AS DOUBLE) AS weight FROM sums),
rates AS (
  SELECT source, CASE WHEN sums.size > 0 THEN 1.0 * ends.size / ends.weight / sums.size ELSE 1.0 END AS lam
  FROM sums, ends),
pois AS (
  SELECT source, lam, 0 AS k, exp(-lam) AS p, exp(-lam) AS c FROM rates
  UNION ALL
  SELECT source, lam, k + 1, p * lam / (k + 1), c + p * lam / (k + 1) FROM pois
  WHERE k < ceil(lam + 12 * sqrt(lam) + 40)),
ids AS (
  SELECT *, concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), 'null'), md5(coalesce(text, ''))) AS id FROM {docs}),
u AS (
  SELECT *, CAST(CAST('0x' || substr(md5('mix|1|' || id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM ids),
n AS (
  SELECT u.*, (SELECT count(*) FROM pois WHERE pois.source IS NOT DISTINCT FROM u.source AND pois.c < u.u) AS n FROM u),
copies AS (SELECT *, CAST(unnest(generate_series(1, n)) AS INTEGER) AS copy FROM n WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, copy,
  substr(md5('mix|order|' || copy || '|' || id), 1, 16) AS order_key
FROM copies
"""
