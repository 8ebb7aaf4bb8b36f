"""Deterministic repairs from playbook entries.

All entries are routed in one pass: each row gets the number of the first entry that covers it,
and actions follow from that number. Deduplication picks one winner per key with a pre-shuffle
group limit and marks rows by joining the winners on ``row_id``, so a key that holds most of the
rows is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions.transforms import chain
from mendflow.sources.playbooks import PLACEHOLDER, STANDARD_TRANSFORMS, STRATEGY_PARAMS, by_priority

PAYLOAD = "map<string,string>"

# Reasons written with dropped and rejected rows.
DUPLICATE_REASON = "duplicate_key_superseded_by_latest"
REJECT_REASON = "rejected_by_playbook"


def usable_entries(entries: Sequence[Mapping], quarantine_fqn: str | None = None) -> list[dict]:
    """Entries in priority order, without unknown strategies, unfinished or out-of-scope ones."""
    kept = []
    for entry in by_priority(entries):
        scope = entry.get("match_fqns") or ["*"]
        if quarantine_fqn is not None and "*" not in scope and quarantine_fqn not in scope:
            continue
        unfinished = PLACEHOLDER in f"{entry.get('params')}{entry.get('where', '')}"
        if entry.get("strategy") in STRATEGY_PARAMS and not unfinished:
            kept.append(entry)
    return kept


def route_playbook(df: DataFrame, entries: Sequence[Mapping]) -> DataFrame:
    """Add ``entry_idx``, the first entry whose rule failed and whose ``where`` holds."""
    matches = []
    for i, entry in enumerate(entries):
        hit = F.array_contains("rule_violations", entry["rule_name"])
        if entry.get("where"):
            hit = hit & F.expr(entry["where"])
        matches.append(F.when(hit, F.lit(i)))
    first = F.coalesce(*matches) if matches else F.lit(None)
    return df.withColumn("entry_idx", first.cast("int"))


def _payload(column: str, value: Column) -> Column:
    return F.create_map(F.lit(column), value.cast("string")).cast(PAYLOAD)


def _reason(text: str) -> Column:
    return F.create_map(F.lit("reason"), F.lit(text)).cast(PAYLOAD)


def _standardize(params: Mapping) -> tuple[Column, Column]:
    if params["transform"] not in STANDARD_TRANSFORMS:
        raise ValueError(f"Unknown transform {params['transform']!r} for standardize_value")
    column = params["column"]
    fixed = chain([{"transform": params["transform"]}], column)
    return F.lit("patch_fields"), _payload(column, fixed)


def _fill(params: Mapping) -> tuple[Column, Column]:
    column = params["column"]
    filled = _payload(column, F.expr(params["default_expr"]))
    if str(params.get("overwrite", False)).lower() != "true":
        filled = F.when(F.col(column).isNull(), filled).otherwise(F.create_map().cast(PAYLOAD))
    return F.lit("patch_fields"), filled


def _reject(params: Mapping) -> tuple[Column, Column]:
    return F.lit("reject"), _reason(params.get("reason", REJECT_REASON))


def _dedupe(params: Mapping) -> tuple[Column, Column]:
    kept = F.col("__winner").isNotNull()
    return (
        F.when(kept, "keep").otherwise("drop"),
        F.when(kept, F.create_map().cast(PAYLOAD)).otherwise(_reason(DUPLICATE_REASON)),
    )


STRATEGIES: dict[str, Callable[[Mapping], tuple[Column, Column]]] = {
    "dedupe_keep_latest": _dedupe,
    "standardize_value": _standardize,
    "fill_default": _fill,
    "reject_rows": _reject,
}


def _winners(routed: DataFrame, dedupes: Mapping[int, Mapping], ties: Sequence[str]) -> DataFrame:
    """``row_id`` of the row to keep per entry and key, for all dedupe entries at once."""
    keys: list[Column] = [F.col("entry_idx")]
    order: list[Column] = []
    for i, params in dedupes.items():
        mine = F.col("entry_idx") == i
        folded = set(params.get("ci_columns") or [])
        for c in params["partition_by"]:
            keys.append(F.when(mine, F.lower(c) if c in folded else F.col(c)))
        value = F.when(mine, F.col(params["order_by"]))
        newest = str(params.get("order_direction", "desc")).lower() == "desc"
        order.append(value.desc_nulls_last() if newest else value.asc_nulls_last())
    best = Window.partitionBy(*keys).orderBy(*order, *ties)
    return (
        routed.filter(F.col("entry_idx").isin(list(dedupes)))
        .withColumn("__rn", F.row_number().over(best))
        .filter("__rn = 1")
        .select("row_id", F.lit(True).alias("__winner"))
    )


def apply_playbook(
    df: DataFrame, entries: Sequence[Mapping], ties: Sequence[str] = ("row_id",)
) -> DataFrame:
    """Matched rows with ``playbook_rule``, ``remediation_action`` and ``action_payload``.

    ``df`` has one row per ``row_id`` with its data columns and ``rule_violations``. Rows no
    entry covers are left out.
    """
    routed = route_playbook(df, entries).filter(F.col("entry_idx").isNotNull())
    dedupes = {
        i: e["params"] for i, e in enumerate(entries) if e["strategy"] == "dedupe_keep_latest"
    }
    marked = routed
    if dedupes:
        marked = routed.join(_winners(routed, dedupes, ties), "row_id", "left")
    action = payload = rule = F.lit(None)
    for i, entry in enumerate(entries):
        mine = F.col("entry_idx") == i
        new_action, new_payload = STRATEGIES[entry["strategy"]](entry.get("params") or {})
        action = F.when(mine, new_action).otherwise(action)
        payload = F.when(mine, new_payload).otherwise(payload)
        rule = F.when(mine, F.lit(entry["rule_name"])).otherwise(rule)
    return marked.withColumns(
        {
            "playbook_rule": rule.cast("string"),
            "remediation_action": action.cast("string"),
            "action_payload": payload.cast(PAYLOAD),
        }
    ).select(*df.columns, "entry_idx", "playbook_rule", "remediation_action", "action_payload")


def _single(df: DataFrame, strategy: str, params: Mapping) -> DataFrame:
    """One strategy over every row of ``df``."""
    frame = df.withColumn("entry_idx", F.lit(0))
    if strategy == "dedupe_keep_latest":
        frame = frame.join(_winners(frame, {0: params}, ("row_id",)), "row_id", "left")
    action, payload = STRATEGIES[strategy](params)
    return frame.withColumns(
        {"remediation_action": action, "action_payload": payload.cast(PAYLOAD)}
    ).select(*df.columns, "remediation_action", "action_payload")


def dedupe_keep_latest(df: DataFrame, params: Mapping) -> DataFrame:
    """Keep the newest (or oldest) row per key and drop the others."""
    return _single(df, "dedupe_keep_latest", params)


def standardize_value(df: DataFrame, params: Mapping) -> DataFrame:
    """Patch one column with a named transform."""
    return _single(df, "standardize_value", params)


def fill_default(df: DataFrame, params: Mapping) -> DataFrame:
    """Patch nulls of one column with an expression; ``overwrite`` patches every row."""
    return _single(df, "fill_default", params)


def reject_rows(df: DataFrame, params: Mapping) -> DataFrame:
    """Mark every row as beyond repair."""
    return _single(df, "reject_rows", params)


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    """Results of several strategies as one frame."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def playbook_updates(
    remediated: DataFrame, quarantine_fqn: str, run_id: str, as_of: Column | None = None
) -> DataFrame:
    """Queue updates for remediated rows; playbook fixes carry full confidence."""
    action = F.col("remediation_action")
    status = (
        F.when(action == "drop", S.RESOLVED_DUPLICATE)
        .when(action == "reject", S.REJECTED)
        .otherwise(S.CURATED)
    )
    return remediated.select(
        F.lit(quarantine_fqn).alias("quarantine_fqn"),
        "row_id",
        F.lit("playbook").alias("remediation_source"),
        F.col("playbook_rule").alias("playbook_strategy"),
        F.lit(None).cast("string").alias("agent_decision"),
        "remediation_action",
        F.col("action_payload").alias("proposed_fix"),
        F.lit(1.0).alias("confidence"),
        status.alias("status"),
        F.lit(run_id).alias("last_run_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("updated_at"),
    )
