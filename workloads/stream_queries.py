"""Streams with state: what a stream finds over several batches and a restart, against SQL over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendflow.streaming import keyed_state
from mendflow.sources import tables
from workloads import fixtures as X
from workloads.registry import query

#: Events in the order of their time, a tenth of them told again two hours later.
_REPEATS = """WITH told AS (
  SELECT event_id, ts, user_id, event_type FROM events
  UNION ALL SELECT event_id, ts + INTERVAL 2 HOUR, user_id, event_type FROM events WHERE event_id % 10 = 0
)
"""


def _in_batches(spark, sf: str, n: int) -> tuple[str, object]:
    """The events as ``n`` files in the order of time."""
    events = X.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")
    told = events.unionByName(events.filter("event_id % 10 = 0").withColumn("ts", F.expr("ts + INTERVAL 2 HOUR")))
    ends = told.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).head()
    place = F.unix_micros(F.col("ts").cast("timestamp"))
    a, b = (told.select(F.unix_micros(F.lit(x).cast("timestamp"))).head()[0] for x in ends)
    part = F.least(F.floor((place - a) * n / (b - a + 1)), F.lit(n - 1)).cast("int")
    folder = tables.scratch_folder(spark)
    for i in range(n):
        told.filter(part == i).coalesce(1).write.mode("append").parquet(folder)
    return folder, told.schema


def _run(spark, source: DataFrame, out: str, checkpoint: str) -> None:
    query = (
        source.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _streamed(spark, sf: str, plan, n: int = 4) -> DataFrame:
    """``plan`` over the files one by one; the query ends halfway and goes on from its checkpoint."""
    folder, schema = _in_batches(spark, sf, n)
    out, checkpoint, seen = (tables.scratch_folder(spark) for _ in range(3))
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = jvm.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((f for f in files.listStatus(jvm.Path(folder)) if f.getPath().getName().startswith("part-")), key=lambda f: f.getModificationTime())
    files.mkdirs(jvm.Path(seen))
    for half in (found[: n // 2], found[n // 2 :]):
        for file in half:
            files.rename(file.getPath(), jvm.Path(f"{seen}/{file.getPath().getName()}"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(seen)
        _run(spark, plan(stream.withColumn("ts", F.col("ts").cast("timestamp"))), out, checkpoint)
    return spark.read.parquet(out)


@query(_REPEATS + """, w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS s, user_id, event_type, count(*) AS n_rows FROM told GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H:%M') AS window_start, user_id, event_type, n_rows FROM w
WHERE n_rows > 1 AND s + INTERVAL 6 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM told)""")
def stream_repeated_keys(spark, sf):
    """Users who repeat a kind of event within six hours, over four batches and a restart."""
    found = _streamed(
        spark, sf, lambda s: keyed_state.repeated_keys_stream(s, ["user_id", "event_type"], "ts", "6 hours", "1 hour")
    )
    return found.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "user_id", "event_type", "n_rows")


@query(_REPEATS + "SELECT DISTINCT event_id FROM told")
def stream_first_rows(spark, sf):
    """An event that is told again within a day passes once, also over batches and a restart."""
    return _streamed(spark, sf, lambda s: keyed_state.first_rows_stream(s, ["event_id"], "ts", "1 day")).select("event_id")
