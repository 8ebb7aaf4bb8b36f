"""Column names, fixed table schemas and status names shared by every module."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Bookkeeping columns of a quarantine table.
ERROR = "_error"
WARNING = "_warning"
ROW_ID = "_row_id"
ROW_ID_KEYS = "_row_id_keys"
GENERATED_AT = "_generated_at"
DATA_SOURCE = "_data_source"
RULE_SOURCES = "_rule_sources"
IS_CROSS_TABLE = "_is_cross_table"
RULE_NAME = "_rule_name"
RULE_COLUMNS = "_rule_columns"

# Review-queue statuses.
PENDING = "pending"
CURATED = "curated"
ESCALATED = "escalated"
REJECTED = "rejected"
RESOLVED_DUPLICATE = "resolved_duplicate"
RESOLVED_REMOVED = "resolved_removed"
REVALIDATED_PASS = "revalidated_pass"
REVALIDATED_FAIL = "revalidated_fail"
REINGESTED = "reingested"

# Statuses that end a row's life in the queue.
TERMINAL_STATUSES = (REINGESTED, RESOLVED_DUPLICATE, RESOLVED_REMOVED, REJECTED)

# Fixed value: suffix of the staged table that belongs to a quarantine table.
STAGED_SUFFIX = "_staged_for_reingest"

# Limits named by the governing policy.
CONFIDENCE_THRESHOLD = 0.8
MAX_RETRIES = 3
SAMPLE_SIZE = 15
PASSING_EXAMPLES = 5
PROBE_THRESHOLD = 0.9

RESULT_DDL = "array<struct<name:string,message:string,function:string,columns:array<string>>>"

# ``run_id`` is the triage run; ``last_run_id`` is the run of the latest transition.
QUEUE_DDL = (
    "review_id string, quarantine_fqn string, row_id string, rule_violations array<string>, "
    "remediation_source string, playbook_strategy string, agent_decision string, "
    "remediation_action string, proposed_fix map<string,string>, confidence double, "
    "status string, retry_count int, data_source string, quarantine_generated_at timestamp, "
    "run_id string, last_run_id string, created_at timestamp, updated_at timestamp"
)

DRY_RUN_DDL = (
    "run_id string, quarantine_fqn string, silver_fqn string, quarantined_rows bigint, "
    "already_resolved bigint, pending_rows bigint, playbook_keep_or_patch bigint, "
    "playbook_would_drop bigint, playbook_would_reject bigint, playbook_would_pass bigint, "
    "playbook_would_fail bigint, agent_eligible bigint, not_reingestable bigint, "
    "est_reingest_insert bigint, est_reingest_update bigint, run_at timestamp"
)

PROPOSAL_DDL = (
    "signature string, decision string, fixes array<map<string,string>>, "
    "confidence double, reasoning string"
)


def column_names(ddl: str) -> list[str]:
    """Column names of a flat DDL string, in order."""
    depth, part, parts = 0, "", []
    for ch in ddl:
        depth += ch in "<("
        depth -= ch in ">)"
        if ch == "," and depth == 0:
            parts.append(part)
            part = ""
        else:
            part += ch
    return [p.split()[0] for p in [*parts, part]]


QUEUE_COLUMNS = column_names(QUEUE_DDL)


def data_columns(df: DataFrame) -> list[str]:
    """The source columns of a quarantine or candidate frame."""
    return [c for c in df.columns if not c.startswith("_") and c not in ("row_id", "rule_violations")]


def require_plain_columns(df: DataFrame) -> None:
    """Refuse inputs whose own columns would clash with bookkeeping names."""
    clash = [c for c in df.columns if c.startswith("_") or c == "row_id"]
    if clash:
        raise ValueError(f"input columns use reserved names (leading '_' or 'row_id'): {clash}")
