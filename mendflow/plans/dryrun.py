"""Read-only estimate of what a run would merge, from the same operators as the real run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators import metrics, playbook, reingest
from mendflow.operators.queue import latest_quarantined
from mendflow.sources import tables


def dry_run_report(
    quarantine: DataFrame,
    queue: DataFrame | None,
    silver: DataFrame,
    entries: Sequence[Mapping],
    checks: Sequence[Mapping],
    quarantine_fqn: str,
    keys: Sequence[str],
    run_id: str = "",
    refs: Mapping[str, DataFrame] | None = None,
    as_of: Column | None = None,
    cut: Callable[[DataFrame], DataFrame] = tables.cut_lineage,
) -> DataFrame:
    """One report row for one quarantine table.

    Each row gets its playbook action, re-validation result and merge action; one aggregation
    over those labels makes the report. ``keys`` are the merge keys of the table. The newest
    rows and their playbook actions feed several counts and are kept in the scratch folder; no
    table is written.
    """
    latest = cut(latest_quarantined(quarantine))
    target = reingest.reingest_target(latest)
    work = metrics.remaining_work(latest, queue, quarantine_fqn)
    pending = metrics.pending_rows(latest, queue, quarantine_fqn)

    usable = playbook.usable_entries(entries, quarantine_fqn)
    handled = cut(playbook.apply_playbook(pending, usable))
    fixed = F.col("remediation_action").isin("keep", "patch_fields")
    columns = S.data_columns(latest)
    patched = reingest.apply_patch(
        handled.filter(fixed).select("row_id", *columns, "action_payload"), "action_payload", columns
    )
    checked = cut(reingest.judge(reingest.revalidate(patched, checks, refs, silver, keys), keys, "merged"))
    split = reingest.merge_split(
        checked.select("row_id", "passed", "outcome", *keys), silver, keys
    ).select("passed", "merge_action", (F.col("outcome") == "merged").alias("merges"))

    actions = handled.agg(
        F.count("*").alias("handled"),
        F.count_if(F.col("remediation_action") == "drop").alias("playbook_would_drop"),
        F.count_if(F.col("remediation_action") == "reject").alias("playbook_would_reject"),
        F.count_if(fixed).alias("fixable"),
    )
    passed = F.col("passed")
    outcomes = split.agg(
        F.count_if(passed).alias("passes"),
        F.count_if(F.col("merges") & (F.col("merge_action") == "insert")).alias("inserts"),
        F.count_if(F.col("merges") & (F.col("merge_action") == "update")).alias("updates"),
    )
    ok = F.coalesce("reingestable", F.lit(False))

    def if_ok(value: Column) -> Column:
        return F.when(ok, value).otherwise(F.lit(0)).cast("bigint")

    # Four frames of exactly one row each, stacked and folded into one row.
    parts = [target.drop("merge_keys", "reason"), work, actions, outcomes]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one_row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return one_row.select(
        F.lit(run_id).alias("run_id"),
        F.lit(quarantine_fqn).alias("quarantine_fqn"),
        "silver_fqn",
        "quarantined_rows",
        "already_resolved",
        "pending_rows",
        if_ok(F.col("fixable")).alias("playbook_keep_or_patch"),
        F.col("playbook_would_drop"),
        F.col("playbook_would_reject"),
        if_ok(F.col("passes")).alias("playbook_would_pass"),
        if_ok(F.col("fixable") - F.col("passes")).alias("playbook_would_fail"),
        if_ok(F.greatest(F.col("pending_rows") - F.col("handled"), F.lit(0))).alias("agent_eligible"),
        F.when(ok, F.lit(0)).otherwise(F.col("pending_rows")).cast("bigint").alias("not_reingestable"),
        if_ok(F.col("inserts")).alias("est_reingest_insert"),
        if_ok(F.col("updates")).alias("est_reingest_update"),
        (F.current_timestamp() if as_of is None else as_of).alias("run_at"),
    )



def dry_run_table(
    spark: SparkSession,
    quarantine_fqn: str,
    queue_fqn: str,
    run_id: str,
    entries: Sequence[Mapping],
    checks_for: Callable[[str], Sequence[Mapping]],
    report_fqn: str | None = None,
    as_of: Column | None = None,
) -> dict:
    """The report of a stored quarantine table, read with the rules and keys a real run would use.

    The row is appended to ``report_fqn`` if that is given; nothing else is written.
    """
    with tables.scratch(spark):
        quarantine = tables.read(spark, quarantine_fqn)
        queue = tables.read(spark, queue_fqn) if tables.exists(spark, queue_fqn) else None
        target = reingest.reingest_target(quarantine).head()
        ok = target["reingestable"]
        silver = tables.read(spark, target["silver_fqn"]) if ok else quarantine.limit(0)
        checks = checks_for(target["silver_fqn"]) if ok else []
        keys = list(target["merge_keys"])
        if not ok:  # no merge is estimated; any column serves as the key
            quarantine = quarantine.withColumn("row_key", F.col(S.ROW_ID))
            silver, keys = quarantine.limit(0), ["row_key"]
        report = dry_run_report(
            quarantine, queue, silver, entries, checks, quarantine_fqn, keys, run_id,
            tables.refs_for(spark, checks), as_of,
        )
        report = tables.cut_lineage(report.select(*S.column_names(S.DRY_RUN_DDL)))
        if report_fqn:
            tables.append(report, report_fqn)
        return report.head().asDict()
