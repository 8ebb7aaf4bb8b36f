"""Kept counts of keys, so that uniqueness holds over all batches and not within one.

A batch's keys are counted and kept as two hashes and a number. Counts of recent batches are small
tables of their own, one for each batch, so a batch that is delivered again replaces what it had
left; every ``merge_after`` batches they are added to the kept table, which is partitioned by key
hash. A new batch reads the recent counts and those partitions of the kept table that its own keys fall
into, never the rows of earlier batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow.sources import tables

_COUNTS = "k1 long, k2 long, n long"


@dataclass
class KeyHistory:
    """The counts kept for one uniqueness check under the table name ``fqn``."""

    spark: SparkSession
    fqn: str
    buckets: int = 256
    merge_after: int = 16

    @property
    def recent_fqn(self) -> str:
        return f"{self.fqn}__recent"

    def _bucket(self):
        return F.pmod(F.col("k1"), F.lit(self.buckets)).cast("int")

    def _read(self, fqn: str) -> DataFrame:
        return tables.read(self.spark, fqn)

    def earlier(self, keys: DataFrame, batch: str | None = None) -> DataFrame:
        """``k1``, ``k2`` and the count ``n`` in all batches but this one, for those of the ``keys`` that have one."""
        wanted = keys.select("k1", "k2").distinct()
        parts = []
        if tables.exists(self.spark, self.fqn):
            # At most one row for each bucket; the scan lists only these partitions.
            touched = [r[0] for r in wanted.select(self._bucket().alias("b")).distinct().collect()]
            parts.append(self._read(self.fqn).filter(F.col("bucket").isin(touched)).select("k1", "k2", "n"))
        if tables.exists(self.spark, self.recent_fqn):
            others = F.lit(True) if batch is None else F.col("batch") != batch
            parts.append(self._read(self.recent_fqn).filter(others).select("k1", "k2", "n"))
        if not parts:
            return self.spark.createDataFrame([], _COUNTS)
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return found.join(wanted, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.sum("n").alias("n"))

    def at(self, batch: int | str) -> Seen:
        return Seen(self, str(batch))

    def record(self, keys: DataFrame, batch: int | str) -> None:
        """Keep the counts of a batch's ``keys`` (``k1``, ``k2``, one row each); a repeated batch replaces its own."""
        counts = keys.groupBy("k1", "k2").agg(F.count("*").alias("n"))
        tables.replace_slice(counts.withColumn("batch", F.lit(str(batch))), self.recent_fqn, "batch", str(batch))
        name = tables.table_name(self.spark, self.recent_fqn)
        kept = [r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]
        if len(kept) > self.merge_after:
            self._merge([b for b in kept if b != str(batch)])

    def _merge(self, batches: list[str]) -> None:
        """Add the counts of these batches to the kept ones. The newest batch stays apart, it may come again.

        The kept table says which batches it holds. Should a run die before the recent counts
        are dropped, the next merge drops them without adding them again.
        """
        held = set()
        if tables.exists(self.spark, self.fqn):
            first = self._read(self.fqn).filter("bucket = -1")
            held = {r["batch"] for r in first.select(F.explode("batches").alias("batch")).collect()}
        fresh = [b for b in batches if b not in held]
        recent = self._read(self.recent_fqn).filter(F.col("batch").isin(fresh)).select("k1", "k2", "n")
        if tables.exists(self.spark, self.fqn):
            recent = recent.unionByName(self._read(self.fqn).filter("bucket >= 0").select("k1", "k2", "n"))
        total = recent.groupBy("k1", "k2").agg(F.sum("n").alias("n"))
        none = F.lit(None).cast("array<string>")
        rows = total.select("k1", "k2", "n", none.alias("batches"), self._bucket().alias("bucket"))
        zero = F.lit(0).cast("long")
        mark = self.spark.range(1).select(
            zero.alias("k1"), zero.alias("k2"), zero.alias("n"), F.array(*[F.lit(b) for b in batches]).alias("batches"), F.lit(-1).alias("bucket")
        )
        whole = rows.repartition("bucket").sortWithinPartitions("bucket", "k1").unionByName(mark)
        if not tables.exists(self.spark, self.fqn):
            tables.create_partitioned(self.spark, self.fqn, whole.schema, "bucket")
        tables.replace(whole, self.fqn)
        name = tables.table_name(self.spark, self.recent_fqn)
        listed = ", ".join(f"PARTITION (batch = '{b}')" for b in batches)
        self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")
        self.spark.catalog.refreshTable(name.replace("`", ""))


@dataclass(frozen=True)
class Seen:
    """A history as one batch meets it."""

    history: KeyHistory
    batch: str

    def earlier(self, keys: DataFrame) -> DataFrame:
        return self.history.earlier(keys, self.batch)

    def record(self, keys: DataFrame) -> None:
        self.history.record(keys, self.batch)

    def repeated_now(self, keys: DataFrame) -> DataFrame:
        """Keys whose one earlier row passed alone and is repeated by this batch, to take that row back."""
        return self.earlier(keys).filter("n = 1").select("k1", "k2")
