"""Audit rows, summary metrics and remaining work, for all tables in one aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendflow import schemas as S


def _status(*names: str) -> Column:
    return F.col("status").isin(*names)


def status_counts(queue: DataFrame, run_id: str | None = None) -> DataFrame:
    """Queue rows per table, run and status."""
    rows = queue if run_id is None else queue.filter(F.col("run_id") == run_id)
    return rows.groupBy("quarantine_fqn", "run_id", "status").agg(F.count("*").alias("n_rows"))


def _run_counts(queue: DataFrame, run_id: str) -> DataFrame:
    """One row per table with the counts both reports use.

    Triage counts by the run that queued the row, outcomes by the run of the last transition.
    """
    triaged = F.col("run_id") == run_id
    moved = F.col("last_run_id") == run_id
    by_playbook = F.col("remediation_source") == "playbook"
    return (
        queue.filter(triaged | moved)
        .groupBy("quarantine_fqn")
        .agg(
            F.count_if(triaged).alias("triaged_count"),
            F.count_if(moved & by_playbook).alias("playbook_resolved_count"),
            F.count_if(moved & _status(S.REINGESTED)).alias("reingested_count"),
            F.count_if(moved & _status(S.ESCALATED)).alias("escalated_count"),
            F.count_if(moved & _status(S.REVALIDATED_FAIL)).alias("still_failing"),
            F.count_if(moved & _status(S.ESCALATED, S.REJECTED)).alias("error_rows"),
        )
    )


def audit_row(queue: DataFrame, run_id: str, as_of: Column | None = None) -> DataFrame:
    """One audit row per table touched by the run."""
    return _run_counts(queue, run_id).select(
        F.lit(run_id).alias("run_id"),
        "quarantine_fqn",
        "triaged_count",
        "playbook_resolved_count",
        "reingested_count",
        "escalated_count",
        F.try_divide("reingested_count", "triaged_count").alias("reingest_rate"),
        (F.current_timestamp() if as_of is None else as_of).alias("run_at"),
    )


def summary_metrics(
    queue: DataFrame, run_id: str, metric_source: str = "reingest", as_of: Column | None = None
) -> DataFrame:
    """One summary row per table in the shape of the shared quality dashboard."""
    return _run_counts(queue, run_id).select(
        F.lit(metric_source).alias("metric_source"),
        F.col("quarantine_fqn").alias("table_fqn"),
        F.lit(run_id).alias("run_id"),
        F.col("triaged_count").alias("input_row_count"),
        F.col("reingested_count").alias("passed_row_count"),
        (F.col("still_failing") + F.col("escalated_count")).alias("failed_row_count"),
        F.col("error_rows").alias("error_row_count"),
        F.lit(0).cast("bigint").alias("warning_row_count"),
        (F.current_timestamp() if as_of is None else as_of).alias("run_at"),
    )


def resolved_rows(queue: DataFrame | None, quarantine_fqn: str) -> DataFrame | None:
    """Distinct rows of one table that reached a terminal status."""
    if queue is None:
        return None
    return (
        queue.filter((F.col("quarantine_fqn") == quarantine_fqn) & _status(*S.TERMINAL_STATUSES))
        .select("row_id")
        .distinct()
    )


def waiting_elsewhere(queue: DataFrame | None, quarantine_fqn: str) -> DataFrame | None:
    """Distinct rows of one table that are tracked and no longer pending: finished or under way."""
    if queue is None:
        return None
    mine = queue.filter(F.col("quarantine_fqn") == quarantine_fqn)
    return mine.filter(~_status(S.PENDING)).select("row_id").distinct()


def pending_rows(latest: DataFrame, queue: DataFrame | None, quarantine_fqn: str) -> DataFrame:
    """Latest quarantined rows that triage and playbook would take up: untracked or pending."""
    done = waiting_elsewhere(queue, quarantine_fqn)
    return latest if done is None else latest.join(done, "row_id", "left_anti")


def remaining_work(
    latest: DataFrame, queue: DataFrame | None, quarantine_fqn: str
) -> DataFrame:
    """``quarantined_rows``, ``already_resolved`` and ``pending_rows`` of one table, one row."""
    marks = [latest.select("row_id", F.lit(1).alias("q"), F.lit(0).alias("d"), F.lit(0).alias("w"))]
    if queue is not None:
        marks += [
            resolved_rows(queue, quarantine_fqn).select("row_id", F.lit(0), F.lit(1), F.lit(0)),
            waiting_elsewhere(queue, quarantine_fqn).select("row_id", F.lit(0), F.lit(0), F.lit(1)),
        ]
    per_row = reduce(DataFrame.unionAll, marks).groupBy("row_id").agg(
        *[F.max(c).alias(c) for c in ("q", "d", "w")]
    )
    return per_row.agg(
        F.coalesce(F.sum("q"), F.lit(0)).alias("quarantined_rows"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("already_resolved"),
        F.count_if((F.col("q") == 1) & (F.col("w") == 0)).alias("pending_rows"),
    )
