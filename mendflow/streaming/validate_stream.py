"""Validation of a stream with the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from mendflow.operators.checks import parse_checks
from mendflow.operators.history import KeyHistory
from mendflow.operators.keychecks import unique_keys
from mendflow.operators.validate import validate
from mendflow.sources import tables

Sink = Callable[[DataFrame, DataFrame, int], None]


def validate_stream(
    stream: DataFrame,
    checks: Sequence[Mapping],
    sources: str | Sequence[str],
    sink: Sink,
    checkpoint: str,
    keys: str | Sequence[str] | None = None,
    refs: Mapping[str, DataFrame] | None = None,
    as_of: Column | None = None,
    every: str | None = None,
    histories: Mapping[str, KeyHistory] | None = None,
) -> StreamingQuery:
    """Validate each micro-batch and hand ``(valid, quarantine, batch_id)`` to the sink.

    Without ``every`` all available data is processed and the query ends. A batch may be
    delivered again after a failure, so the sink should write by ``batch_id``, as
    ``partitioned_sink`` does. Uniqueness is decided within a batch, or over all batches so far for
    a check whose argument ``history`` names one of the ``histories``.
    """
    parsed = parse_checks(checks)
    remembered = [c for c in parsed if c.arguments.get("history")]

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Both outputs and the key counts read the batch; lost blocks are read from the source again.
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with tables.scratch(batch.sparkSession):
                seen = {name: h.at(batch_id) for name, h in (histories or {}).items()}
                valid, quarantine = validate(kept, parsed, sources, keys, {**(refs or {}), **seen}, as_of)
                sink(valid, quarantine, batch_id)
                for check in remembered:
                    seen[check.arguments["history"]].record(unique_keys(kept, check))
        finally:
            kept.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def partitioned_sink(valid_path: str, quarantine_path: str) -> Sink:
    """Write both outputs under their batch number; writing a batch again replaces it."""

    def write(valid: DataFrame, quarantine: DataFrame, batch_id: int) -> None:
        for frame, path in ((valid, valid_path), (quarantine, quarantine_path)):
            frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def validate_rows_stream(stream: DataFrame, checks: Sequence[Mapping]) -> DataFrame:
    """Row checks as a plain streaming projection; dataset checks need ``validate_stream``."""
    from mendflow.operators.checks import DATASET_CHECKS, evaluate

    parsed = parse_checks(checks)
    stateful = [c.name for c in parsed if c.function in DATASET_CHECKS]
    if stateful:
        raise ValueError(f"checks need whole batches: {stateful}")
    return evaluate(stream, parsed)
