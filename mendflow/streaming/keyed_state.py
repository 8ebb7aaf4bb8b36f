"""Uniqueness inside a running stream, by state that expires.

Both operators keep one entry for each key in Spark's state store, in the checkpoint of the query, so a
restarted query goes on where it was, and both forget a key once the watermark has passed it. Rows that
come later than the watermark allows are not counted and not passed on: they are in
``numRowsDroppedByWatermark`` of the query's progress, and ``late_rows`` finds them in the stored input.
For uniqueness without an end use ``validate_stream`` with a ``KeyHistory``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows_stream(stream: DataFrame, keys: Sequence[str], time: str, within: str) -> DataFrame:
    """The first row that arrives of each key; the key is forgotten when the watermark is ``within`` past that row.

    Until then others of that key go. The watermark is ``within`` behind the newest row of earlier batches.
    """
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))


def repeated_keys_stream(
    stream: DataFrame, keys: Sequence[str], time: str, window: str, late: str, slide: str | None = None
) -> DataFrame:
    """Keys with several rows in a window of event time, when the window is over.

    ``late`` is how long after the newest row older ones may still come. Null keys are distinct.
    """
    known = stream.filter(F.col(time).isNotNull())
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    counts = known.withWatermark(time, late).groupBy(F.window(time, window, slide), *keys).agg(F.count("*").alias("n_rows"))
    return counts.filter("n_rows > 1").select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n_rows"
    )


def late_rows(rows: DataFrame, batch: str, time: str, late: str) -> DataFrame:
    """Stored rows with their ``batch`` number that came after the watermark: older by ``late`` than an earlier batch's newest."""
    newest = rows.groupBy(F.col(batch).alias("__batch")).agg(F.max(time).alias("__newest"))
    # One row for each batch.
    before = F.broadcast(newest)
    reached = (
        rows.select(F.col(batch).alias("__own")).distinct().join(before, F.col("__batch") < F.col("__own"), "left")
        .groupBy("__own").agg(F.max("__newest").alias("__newest"))
    )
    edge = F.col("__newest") - F.expr(f"INTERVAL {late}")
    return rows.join(F.broadcast(reached), F.col(batch) == F.col("__own")).filter(F.col(time) < edge).drop("__own", "__newest")
