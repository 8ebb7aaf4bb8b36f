"""What was appended to a table since a reader was last there.

Tables made by ``tables.append`` have a partition for each append. A reader keeps the names of the appends
it is done with in its own slice of a table of marks; the next time it reads the other partitions
only, so its work follows what is new and not what is there. A table without such partitions, or one that
was rewritten since, is read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow.sources import tables

#: Name of the append that a row came with, in the frames of this module.
CAME_WITH = "__came_with"


def appends(spark: SparkSession, fqn: str) -> list[str]:
    """Names of a table's appends, the oldest first; one name for each append comes to the driver."""
    if tables.all_partition_columns(spark, fqn) != [tables.APPEND]:
        return []
    shown = spark.sql(f"SHOW PARTITIONS {tables.table_name(spark, fqn)}").collect()
    return sorted(r[0].split("=", 1)[1] for r in shown)


def marked(spark: SparkSession, marks_fqn: str, reader: str) -> set[str]:
    """The appends that a reader is done with."""
    if not tables.exists(spark, marks_fqn):
        return set()
    own = tables.read(spark, marks_fqn).filter(F.col("reader") == reader)
    return {r["append"] for r in own.select("append").collect()}


def unread(spark: SparkSession, fqn: str, marks_fqn: str, reader: str) -> tuple[DataFrame, list[str]]:
    """The rows of appends that the reader is not done with, and the names of those appends."""
    every = appends(spark, fqn)
    table = spark.read.table(tables.table_name(spark, fqn))
    if not every:
        return tables.read(spark, fqn).withColumn(CAME_WITH, F.lit(None).cast("string")), []
    done = marked(spark, marks_fqn, reader)
    new = [a for a in every if a not in done]
    return table.filter(F.col(tables.APPEND).isin(new)).withColumnRenamed(tables.APPEND, CAME_WITH), new


def mark(spark: SparkSession, fqn: str, marks_fqn: str, reader: str, done: Sequence[str]) -> None:
    """The reader is done with these appends too. Names of appends that are gone are forgotten."""
    there = set(appends(spark, fqn))
    kept = sorted((marked(spark, marks_fqn, reader) | set(done)) & there)
    rows = spark.createDataFrame([(a, reader) for a in kept], "append string, reader string")
    tables.replace_slice(rows, marks_fqn, "reader", reader)
