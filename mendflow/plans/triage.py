"""Triage of what is new in a quarantine table, with a mark of how far it has got."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow.operators import queue as Q
from mendflow.sources import changes, tables


@dataclass
class Changes:
    """New queue rows, and the appends they were found in."""

    spark: SparkSession
    quarantine_fqn: str
    marks_fqn: str
    rows: DataFrame
    new: DataFrame
    appends: list[str]
    requeue: str

    def done(self, queue: DataFrame) -> None:
        """Call when the new rows are in the stored queue. A pass that dies before reads the same appends again."""
        waiting: set[str] = set()
        if self.requeue == "newer":  # at most one name for each append
            held = Q.waiting_appends(self.rows, queue, self.quarantine_fqn, changes.CAME_WITH)
            waiting = {r[0] for r in held.collect()}
        read = [a for a in self.appends if a not in waiting]
        changes.mark(self.spark, self.quarantine_fqn, self.marks_fqn, self.quarantine_fqn, read)


def triage_changes(
    spark: SparkSession,
    quarantine_fqn: str,
    queue: DataFrame,
    marks_fqn: str,
    run_id: str,
    as_of: Column | None = None,
    requeue: str = "never",
) -> Changes:
    """Queue rows for what was appended since the last pass: the same rows that triage of the whole table gives.

    The newest version of a row is chosen among the new appends: a row that no pass has queued has no
    older version, and of a queued one only newer versions count.
    """
    rows, appends = changes.unread(spark, quarantine_fqn, marks_fqn, quarantine_fqn)
    rows = tables.cut_lineage(rows)
    latest = Q.latest_quarantined(rows.drop(changes.CAME_WITH))
    new = Q.triage_latest(latest, queue, quarantine_fqn, run_id, as_of, requeue)
    return Changes(spark, quarantine_fqn, marks_fqn, rows, new, appends, requeue)
