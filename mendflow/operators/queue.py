"""The review queue: seeding, status transitions, resets and change lists.

Updates never list ids on the driver. Each one is a projection of the queue joined with a
frame that has one row per ``(quarantine_fqn, row_id)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions.identity import rule_violations
from mendflow.operators.lookup import latest_per_row

ROW_KEY = ["quarantine_fqn", "row_id"]


def latest_quarantined(quarantine: DataFrame) -> DataFrame:
    """Newest version of each quarantined row, with ``row_id`` and ``rule_violations``."""
    return latest_per_row(quarantine, S.ROW_ID, S.GENERATED_AT).withColumns(
        {"row_id": F.col(S.ROW_ID), "rule_violations": rule_violations()}
    )


def reset_queue(queue: DataFrame, quarantine_fqn: str) -> DataFrame:
    """The queue without the rows of one quarantine table."""
    return queue.filter(F.col("quarantine_fqn") != quarantine_fqn)


def triage(
    quarantine: DataFrame,
    queue: DataFrame,
    quarantine_fqn: str,
    run_id: str,
    as_of: Column | None = None,
    requeue: str = "never",
) -> DataFrame:
    """Queue rows for quarantined rows that are not tracked yet.

    ``requeue="newer"`` also returns rows that failed again after reaching a terminal status.
    """
    return triage_latest(latest_quarantined(quarantine), queue, quarantine_fqn, run_id, as_of, requeue)


def waiting_appends(rows: DataFrame, queue: DataFrame, quarantine_fqn: str, came_with: str) -> DataFrame:
    """Appends with rows that are newer than what the queue holds of them while that is still open.

    Once it is closed such a row is queued again, so its append has to be read again.
    """
    done = F.col("status").isin(*S.TERMINAL_STATUSES)
    tracked = queue.filter(F.col("quarantine_fqn") == quarantine_fqn)
    seen = tracked.groupBy("row_id").agg(F.bool_and(done).alias("__done"), F.max("quarantine_generated_at").alias("__seen_at"))
    ids = rows.select(F.col(S.ROW_ID).alias("row_id"), F.col(S.GENERATED_AT).alias("__at"), came_with)
    held = ids.join(seen, "row_id").filter(~F.col("__done") & (F.col("__at") > F.col("__seen_at")))
    return held.select(came_with).distinct()


def latest_of(quarantine: DataFrame, ids: DataFrame) -> DataFrame:
    """Newest version of the quarantined rows with these ``row_id``; rows of other ids are not shuffled."""
    wanted = ids.select(F.col("row_id").alias(S.ROW_ID)).distinct()
    return latest_quarantined(quarantine.join(wanted, S.ROW_ID, "left_semi"))


def triage_latest(
    latest: DataFrame,
    queue: DataFrame,
    quarantine_fqn: str,
    run_id: str,
    as_of: Column | None = None,
    requeue: str = "never",
) -> DataFrame:
    """``triage`` for rows already cut to their newest version."""
    if requeue not in ("never", "newer"):
        raise ValueError("requeue must be 'never' or 'newer'")
    as_of = F.current_timestamp() if as_of is None else as_of
    tracked = queue.filter(F.col("quarantine_fqn") == quarantine_fqn)
    if requeue == "newer":
        done = F.col("status").isin(*S.TERMINAL_STATUSES)
        # One row id may have been queued several times; open work or the newest time counts.
        seen = tracked.groupBy("row_id").agg(
            F.bool_and(done).alias("__done"),
            F.max("quarantine_generated_at").alias("__seen_at"),
        )
        joined = latest.join(seen, "row_id", "left")
        again = F.col("__done") & (F.col(S.GENERATED_AT) > F.col("__seen_at"))
        new = joined.filter(F.col("__done").isNull() | again).drop("__done", "__seen_at")
    else:
        new = latest.join(tracked.select("row_id"), "row_id", "left_anti")
    seeded = {
        "review_id": F.sha2(
            F.concat_ws(
                "\x1f", F.lit(quarantine_fqn), "row_id", F.col(S.GENERATED_AT).cast("string")
            ),
            256,
        ),
        "quarantine_fqn": F.lit(quarantine_fqn),
        "status": F.lit(S.PENDING),
        "retry_count": F.lit(0),
        "data_source": F.col(S.DATA_SOURCE),
        "quarantine_generated_at": F.col(S.GENERATED_AT),
        "run_id": F.lit(run_id),
        "last_run_id": F.lit(run_id),
        "created_at": as_of,
        "updated_at": as_of,
    }
    types = {"remediation_source": "string", "playbook_strategy": "string",
             "agent_decision": "string", "remediation_action": "string",
             "proposed_fix": "map<string,string>", "confidence": "double"}
    blanks = {c: F.lit(None).cast(t) for c, t in types.items()}
    return new.withColumns({**seeded, **blanks}).select(*S.QUEUE_COLUMNS)


# Columns a transition may set.
UPDATABLE = (
    "remediation_source", "playbook_strategy", "agent_decision", "remediation_action",
    "proposed_fix", "confidence", "status", "retry_count", "last_run_id", "updated_at",
)


def apply_queue_updates(
    queue: DataFrame, updates: DataFrame, from_status: str | Sequence[str] | None = S.PENDING
) -> DataFrame:
    """Merge updates into the queue; only rows in ``from_status`` change.

    ``updates`` has ``quarantine_fqn``, ``row_id`` and any of the updatable columns.
    """
    changed = [c for c in UPDATABLE if c in updates.columns]
    allowed = [from_status] if isinstance(from_status, str) else from_status
    source = updates.select(
        *ROW_KEY, *[F.col(c).alias(f"__new_{c}") for c in changed], F.lit(True).alias("__hit")
    )
    hit = F.col("__hit").isNotNull()
    if allowed is not None:
        hit = hit & F.col("status").isin(*allowed)
    joined = queue.join(source, ROW_KEY, "left").withColumn("__hit", hit)
    return joined.select(
        *[
            F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in queue.columns
        ]
    )


def actionable(
    queue: DataFrame,
    threshold: float = S.CONFIDENCE_THRESHOLD,
    max_retries: int = S.MAX_RETRIES,
    include_passed: bool = True,
) -> DataFrame:
    """Rows ready to be applied: confident fixes, failures with retries left, and rows that
    passed earlier but were never merged."""
    ready = (F.col("status") == S.CURATED) & (F.col("confidence") >= threshold)
    retry = (F.col("status") == S.REVALIDATED_FAIL) & (F.col("retry_count") < max_retries)
    waiting = (F.col("status") == S.REVALIDATED_PASS) & F.lit(include_passed)
    return queue.filter(ready | retry | waiting)


def advance_queue(
    queue: DataFrame,
    outcomes: DataFrame,
    run_id: str,
    as_of: Column | None = None,
) -> DataFrame:
    """Apply re-validation outcomes: ``(quarantine_fqn, row_id, outcome)``.

    Outcomes are ``removed``, ``not_mergeable``, ``pass``, ``fail`` and ``merged``. Rows that
    are closed, pending or escalated do not move.
    """
    to_status = {
        "removed": S.RESOLVED_REMOVED,
        "not_mergeable": S.ESCALATED,
        "pass": S.REVALIDATED_PASS,
        "fail": S.REVALIDATED_FAIL,
        "merged": S.REINGESTED,
    }
    as_of = F.current_timestamp() if as_of is None else as_of
    hit = outcomes.select(*ROW_KEY, F.col("outcome").alias("__new_outcome"))
    open_row = F.col("status").isin(S.CURATED, S.REVALIDATED_PASS, S.REVALIDATED_FAIL)
    status = F.col("status")
    for outcome, target in to_status.items():
        status = F.when(F.col("__outcome") == outcome, target).otherwise(status)
    moved = F.col("__outcome").isNotNull()
    updated = {
        "retry_count": F.col("retry_count") + (F.coalesce("__outcome", F.lit("")) == "fail").cast("int"),
        "last_run_id": F.when(moved, F.lit(run_id)).otherwise(F.col("last_run_id")),
        "updated_at": F.when(moved, as_of).otherwise(F.col("updated_at")),
        "status": status,
    }
    return (
        queue.join(hit, ROW_KEY, "left")
        .withColumn("__outcome", F.when(open_row, F.col("__new_outcome")))
        .withColumns(updated)
        .select(*queue.columns)
    )


def _exhausted(max_retries: int) -> Column:
    return (F.col("status") == S.REVALIDATED_FAIL) & (F.col("retry_count") >= max_retries)


def would_escalate(queue: DataFrame, max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """Per table, how many rows ``escalate_exhausted`` would move."""
    spent = F.count_if(_exhausted(max_retries))
    return queue.groupBy("quarantine_fqn").agg(spent.alias("would_escalate"))


def escalate_exhausted(
    queue: DataFrame,
    max_retries: int = S.MAX_RETRIES,
    run_id: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Escalate failures that have used up their retries."""
    spent = _exhausted(max_retries)
    as_of = F.current_timestamp() if as_of is None else as_of
    changes = {
        "updated_at": F.when(spent, as_of).otherwise(F.col("updated_at")),
        "status": F.when(spent, F.lit(S.ESCALATED)).otherwise(F.col("status")),
    }
    if run_id is not None:
        changes["last_run_id"] = F.when(spent, F.lit(run_id)).otherwise(F.col("last_run_id"))
    return queue.withColumns(changes).select(*queue.columns)


def queue_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows added, removed or moved to another status between two versions of the queue."""
    old = before.select("review_id", F.col("status").alias("old_status"))
    new = after.select("review_id", F.col("status").alias("new_status"))
    change = (
        F.when(F.col("old_status").isNull(), "insert")
        .when(F.col("new_status").isNull(), "delete")
        .otherwise("update")
    )
    return (
        old.join(new, "review_id", "full_outer")
        .filter(~F.col("old_status").eqNullSafe(F.col("new_status")))
        .withColumn("change", change)
    )
