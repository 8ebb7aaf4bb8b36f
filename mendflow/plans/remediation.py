"""One remediation pass over one quarantine table, from triage to the merged clean table.

Every step returns lazy DataFrames; nothing but the playbook entries and the checks of the
table is held by the driver. Three results are written to the scratch folder because several
outputs read them: the newest quarantined rows, the queue after curation, and the re-validated
rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators import curate, induce, metrics, playbook, probe, reingest
from mendflow.operators import queue as Q
from mendflow.sources import tables

Proposer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Probe:
    """How a cross-table rule's mismatches may be resolved: compare a column with another table's."""

    column: str
    other_table: str
    join_keys: Sequence[str]
    normalizations: Sequence[str] = ("trim", "lower_trim", "upper_trim")
    threshold: float = S.PROBE_THRESHOLD


def _probed(rest: DataFrame, rule: str, p: Probe, refs: Mapping[str, DataFrame]) -> DataFrame:
    other = refs[p.other_table] if p.other_table in refs else tables.read(rest.sparkSession, p.other_table)
    mine = rest.filter(F.array_contains("rule_violations", rule))
    return probe.cross_table_probe(mine, other, p.column, p.join_keys, p.normalizations, threshold=p.threshold)


def first_proposals(first: DataFrame, then: DataFrame) -> DataFrame:
    """Proposals of ``first``, and those of ``then`` for the other signatures."""
    return first.unionByName(then.join(first.select("signature"), "signature", "left_anti"))


@dataclass
class Pass:
    """Results of one pass; all lazy. ``queue`` holds the rows of the processed table."""

    queue: DataFrame
    other_queues: DataFrame
    staged: DataFrame
    silver: DataFrame
    merge_split: DataFrame
    decisions: DataFrame
    audit: DataFrame
    summary: DataFrame


def curated_queue(
    latest: DataFrame,
    queue: DataFrame,
    quarantine_fqn: str,
    run_id: str,
    entries: Sequence[Mapping],
    propose: Proposer,
    threshold: float = S.CONFIDENCE_THRESHOLD,
    requeue: str = "never",
    as_of: Column | None = None,
    probes: Mapping[str, Probe] | None = None,
    refs: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Triage, playbook and proposals: the updated queue and the row decisions.

    Playbook and proposals cover different rows, so the queue is joined with both at once. A rule
    with a probe is first compared with its other table; only signatures for which no probe has
    an answer take the proposer's.
    """
    new = Q.triage_latest(latest, queue, quarantine_fqn, run_id, as_of, requeue)
    queued = queue.unionByName(new)
    open_ids = queued.filter(
        (F.col("quarantine_fqn") == quarantine_fqn) & (F.col("status") == S.PENDING)
    ).select("row_id")
    pending = latest.join(open_ids, "row_id", "left_semi")

    usable = playbook.usable_entries(entries, quarantine_fqn)
    handled = playbook.apply_playbook(pending, usable)
    rest = curate.with_signature(
        playbook.route_playbook(pending, usable).filter("entry_idx is null").drop("entry_idx")
    )
    proposals = propose(rest)
    for rule, p in reversed((probes or {}).items()):
        proposals = first_proposals(_probed(rest, rule, p, refs or {}), proposals)
    decisions = curate.apply_proposals(rest, proposals)
    updates = playbook.playbook_updates(handled, quarantine_fqn, run_id, as_of).unionByName(
        curate.decisions_to_updates(decisions, quarantine_fqn, run_id, threshold, as_of),
        allowMissingColumns=True,
    )
    return Q.apply_queue_updates(queued, updates), decisions


def remediate(
    quarantine: DataFrame,
    queue: DataFrame,
    silver: DataFrame,
    quarantine_fqn: str,
    run_id: str,
    entries: Sequence[Mapping],
    checks: Sequence[Mapping],
    keys: Sequence[str],
    propose: Proposer | None = None,
    refs: Mapping[str, DataFrame] | None = None,
    probes: Mapping[str, Probe] | None = None,
    threshold: float = S.CONFIDENCE_THRESHOLD,
    max_retries: int = S.MAX_RETRIES,
    gate: str = "rows",
    requeue: str = "never",
    reset_queue: bool = False,
    reingestable: bool = True,
    dry_run: bool = False,
    as_of: Column | None = None,
    cut: Callable[[DataFrame], DataFrame] = tables.cut_lineage,
    induce_repairs: bool = False,
) -> Pass:
    """The whole pass for one table whose merge target and keys are known.

    With ``dry_run`` rows stay ``revalidated_pass`` and the clean table is unchanged; a later
    run takes them up again. With ``reset_queue`` the table's queue rows are dropped first and
    its quarantined rows are triaged from scratch. With ``induce_repairs`` the transforms that are
    tried also come from the shapes of the failing values and of the clean table's.
    """
    if propose is None:

        def propose(rows: DataFrame) -> DataFrame:
            found = induce.induced_candidates(rows, silver, checks) if induce_repairs else None
            return curate.search_transforms(rows, checks, found)

    others = Q.reset_queue(queue, quarantine_fqn)
    mine = F.col("quarantine_fqn") == quarantine_fqn
    queue = queue.filter(F.lit(False) if reset_queue else mine)
    latest = cut(Q.latest_quarantined(quarantine))
    queued, decisions = curated_queue(
        latest, queue, quarantine_fqn, run_id, entries, propose, threshold, requeue, as_of, probes, refs
    )
    queued = cut(queued)

    ready = Q.actionable(queued, threshold, max_retries)
    if gate == "table":
        opened = curate.confidence_gate(queued, threshold, "table").select("row_id")
        waiting = ready.filter(F.col("status") != S.CURATED)
        ready = waiting.unionByName(
            ready.filter(F.col("status") == S.CURATED).join(opened, "row_id", "left_semi")
        )
    is_drop = F.coalesce(F.col("remediation_action") == "drop", F.lit(False))
    removed = ready.filter(is_drop).select("row_id", F.lit("removed").alias("outcome"))
    to_check = ready.filter(~is_drop)

    columns = S.data_columns(latest)
    if reingestable:
        candidates = reingest.apply_patch(
            latest.select("row_id", *columns).join(to_check.select("row_id", "proposed_fix"), "row_id"),
            columns=columns,
        )
        merged = "pass" if dry_run else "merged"
        checked = cut(reingest.judge(reingest.revalidate(candidates, checks, refs, silver, keys), keys, merged))
        outcomes = removed.unionByName(checked.select("row_id", "outcome"))
        mergeable = F.col("outcome") != "not_mergeable"
        staged = cut(reingest.stage(checked.filter(mergeable).drop("outcome"), ready))
    else:
        outcomes = removed.unionByName(
            to_check.select("row_id", F.lit("not_mergeable").alias("outcome"))
        )
        empty = latest.select("row_id", *columns).filter(F.lit(False)).withColumns(
            {"passed": F.lit(True), S.ERROR: F.lit(None).cast(S.RESULT_DDL)}
        )
        staged = reingest.stage(empty, ready)

    lineage = reingest.with_lineage(staged, run_id, as_of)
    if reingestable:
        aligned, _ = reingest.align_to_target(lineage, silver, keys)
        split = reingest.merge_split(aligned, silver, keys)
        after = silver if dry_run else reingest.merge_upsert(silver, aligned, keys)
    else:
        split = lineage.withColumn("merge_action", F.lit("insert"))
        after = silver

    final = Q.advance_queue(
        queued, outcomes.withColumn("quarantine_fqn", F.lit(quarantine_fqn)), run_id, as_of
    )
    if not dry_run:
        final = Q.escalate_exhausted(final, max_retries, run_id, as_of)
    return Pass(
        queue=final,
        other_queues=others,
        staged=staged,
        silver=after,
        merge_split=split,
        decisions=decisions,
        audit=metrics.audit_row(final, run_id, as_of),
        summary=metrics.summary_metrics(final, run_id, as_of=as_of),
    )


def remediate_table(
    spark: SparkSession,
    quarantine_fqn: str,
    queue_fqn: str,
    run_id: str,
    entries: Sequence[Mapping],
    checks_for: Callable[[str], Sequence[Mapping]],
    audit_fqn: str | None = None,
    metrics_fqn: str | None = None,
    **options,
) -> dict:
    """Run one pass on stored tables and write its results; returns the audit row and merge counts.

    In a dry run ``inserted`` and ``updated`` say what a real run would do.

    The clean table and the queue are written before the old versions are let go; a pass that
    dies in between can be run again, because merging the same rows twice changes nothing. Tables
    that the checks or probes compare with are read by name unless ``refs`` has them. Of a
    partitioned clean table only the partitions that gain or change rows are written.
    """
    with tables.scratch(spark):
        quarantine = tables.read(spark, quarantine_fqn)
        queue = (
            tables.read(spark, queue_fqn)
            if tables.exists(spark, queue_fqn)
            else spark.createDataFrame([], S.QUEUE_DDL)
        )
        target = reingest.reingest_target(quarantine).head()
        silver_fqn, keys = target["silver_fqn"], list(target["merge_keys"])
        ok = target["reingestable"]
        silver = tables.read(spark, silver_fqn) if ok else quarantine.limit(0)
        checks = checks_for(silver_fqn) if ok else []
        options["refs"] = tables.refs_for(spark, checks, options.get("refs"))
        done = remediate(
            quarantine, queue, silver, quarantine_fqn, run_id, entries, checks, keys, reingestable=ok, **options
        )
        final = tables.cut_lineage(done.queue)
        moved = reingest.merge_counts(done.merge_split).head().asDict()  # before the target changes
        if ok and not options.get("dry_run"):
            _merge(spark, silver_fqn, silver, done, keys)
        tables.replace(done.staged.drop("row_id"), quarantine_fqn + S.STAGED_SUFFIX)
        tables.replace_slice(final, queue_fqn, "quarantine_fqn", quarantine_fqn)
        audit = tables.cut_lineage(metrics.audit_row(final, run_id))
        if audit_fqn:
            tables.append(audit, audit_fqn)
        if metrics_fqn:
            tables.append(metrics.summary_metrics(final, run_id), metrics_fqn)
        row = audit.head()
    return (row.asDict() if row else {}) | {"inserted": moved["would_insert"], "updated": moved["would_update"]}


def _merge(
    spark: SparkSession, silver_fqn: str, silver: DataFrame, done: Pass, keys: Sequence[str]
) -> None:
    rows = done.merge_split.drop("merge_action")
    if tables.supports_merge(spark, silver_fqn):
        view = f"mendflow_staged_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            spark.sql(reingest.merge_sql(tables.table_name(spark, silver_fqn), view, rows.columns, keys))
        finally:
            spark.catalog.dropTempView(view)
        return
    parts = tables.partition_columns(spark, silver_fqn)
    if not parts:
        tables.replace(done.silver, silver_fqn)
        return
    touched = tables.cut_lineage(reingest.touched_partitions(silver, rows, keys, parts))
    # A row may move: its key is looked for in all touched partitions, old and new.
    here = reingest.in_partitions(silver, touched, parts)
    tables.replace_partitions(reingest.merge_upsert(here, rows, keys), silver_fqn, touched)


@dataclass(frozen=True)
class Outcome:
    """What became of one table: its counts, or the error that stopped it."""

    fqn: str
    result: object = None
    error: str | None = None


def process_all(
    spark: SparkSession,
    schema: str,
    run: Callable[[str], object],
    prefix: str = "",
    parallel: int = 4,
) -> list[Outcome]:
    """Run a pass for each quarantine table of a schema, several at a time.

    Only table names reach the driver. A table that fails does not stop the others.
    """
    names = [r["fqn"] for r in tables.discover(spark, schema, prefix).orderBy("fqn").collect()]

    def one(name: str) -> Outcome:
        try:
            return Outcome(name, run(name))
        except Exception as problem:  # kept apart and reported
            return Outcome(name, error=f"{type(problem).__name__}: {problem}")

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return list(pool.map(one, names))
