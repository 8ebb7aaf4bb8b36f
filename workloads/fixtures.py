"""Inputs derived from the driver's tables.

The tables hold almost no defects, so defects are put in by arithmetic on keys. Each derived
table is one SELECT text used by both Spark and the checking engine; ``{...}`` marks the few
spots where the dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mendflow.operators import queue as Q
from mendflow.operators import validate as V

DIALECT = {
    "spark": {
        "text": "STRING",
        "upd": "timestampadd(DAY, CAST(o_orderkey % 7 AS INT), o_orderdate)",
        "sha": "sha2({0}, 256)",
        "check": "`check`",
        "quote": "\"'\"",
    },
    "duckdb": {
        "text": "VARCHAR",
        "upd": "o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER))",
        "sha": "sha256({0})",
        "check": '"check"',
        "quote": "chr(39)",
    },
}


def _fill(sql: str, dialect: str) -> str:
    d = DIALECT[dialect]
    return (
        sql.replace("{TEXT}", d["text"])
        .replace("{UPD}", d["upd"])
        .replace("{CHECK}", d["check"])
        .replace("{QUOTE}", d["quote"])
        .replace("{ROWID}", d["sha"].format(f"CAST(o_orderkey AS {d['text']})"))
    )


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the driver; its schema is looked up once."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A derivation as a Spark DataFrame."""
    text = _fill(globals()[name], "spark")
    source = re.search(r"FROM (\w+)", text).group(1)
    table(spark, sf, source).createOrReplaceTempView(source)
    return spark.sql(text)


def sql(name: str) -> str:
    """A derivation in the checking engine's dialect."""
    return _fill(globals()[name], "duckdb")


DIRTY = """SELECT CAST(o_orderkey AS BIGINT) AS order_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
  o_orderdate AS order_ts, {UPD} AS updated_at,
  CASE WHEN o_orderkey % 31 = 0 THEN 'Duplicate' WHEN o_orderkey % 37 = 0 THEN 'Invalid'
       ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 41 = 0 THEN concat('A', lpad(CAST(o_orderkey % 10000 AS {TEXT}), 4, '0'))
       ELSE lpad(CAST(o_orderkey % 100000 AS {TEXT}), 5, '0') END AS code,
  CASE WHEN o_orderkey % 43 = 0 THEN concat('  ', lower(o_orderpriority), ' ')
       ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount
FROM orders"""

SILVER = """SELECT CAST(o_orderkey AS BIGINT) AS order_id, o_custkey AS customer_id,
  o_orderdate AS order_ts, {UPD} AS updated_at, o_orderstatus AS status,
  lpad(CAST(o_orderkey % 100000 AS {TEXT}), 5, '0') AS code, o_orderpriority AS priority,
  o_totalprice AS amount, CAST(NULL AS BOOLEAN) AS agent_curated,
  CAST(NULL AS DOUBLE) AS confidence, 'store' AS channel
FROM orders WHERE o_orderstatus <> 'P'"""

QUEUE = """SELECT concat('q', CAST(o_orderkey AS {TEXT})) AS review_id,
  concat('main.quarantine.silver_', lower(substring(o_orderpriority, 3))) AS quarantine_fqn,
  {ROWID} AS row_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'playbook' WHEN o_orderkey % 3 = 1 THEN 'agent' END AS remediation_source,
  CASE WHEN o_orderkey % 3 = 1 THEN CASE WHEN o_orderstatus = 'P' THEN 'reject' ELSE 'fix' END END AS agent_decision,
  CASE WHEN o_orderkey % 10 = 7 THEN 'drop' WHEN o_orderkey % 10 = 8 THEN 'keep'
       WHEN o_orderkey % 10 < 5 THEN 'patch_fields' END AS remediation_action,
  CASE WHEN o_totalprice > 100000 OR o_orderpriority = '5-LOW' THEN 1.0E0 ELSE 0.7E0 END AS confidence,
  CASE o_orderkey % 11 WHEN 0 THEN 'pending' WHEN 1 THEN 'curated' WHEN 2 THEN 'escalated'
       WHEN 3 THEN 'rejected' WHEN 4 THEN 'resolved_duplicate' WHEN 5 THEN 'resolved_removed'
       WHEN 6 THEN 'revalidated_pass' WHEN 7 THEN 'revalidated_fail' WHEN 8 THEN 'reingested'
       WHEN 9 THEN 'curated' ELSE 'revalidated_fail' END AS status,
  CAST(o_orderkey % 5 AS INT) AS retry_count,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'run1' ELSE 'run2' END AS run_id,
  CASE WHEN o_custkey % 2 = 0 THEN 'run2' ELSE 'run3' END AS last_run_id
FROM orders"""

RULES = """SELECT concat('r', CAST(p_partkey AS {TEXT})) AS rule_id,
  concat('main.silver.', lower(replace(p_brand, '#', ''))) AS table_fqn,
  CASE WHEN p_type = 'PROMO' THEN 'draft' WHEN p_type = 'LARGE' THEN 'Approved' ELSE 'approved' END AS status,
  CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN '{not json'
       WHEN p_size < 6 THEN concat('[{"name":"', p_name, ' a","check":{"function":"is_not_null"}},',
         '{"name":"', p_name, ' b","user_metadata":{"monitor_only":"true"}}]')
       ELSE concat('{"name":"', p_name, '","criticality":"', CASE WHEN p_size > 25 THEN 'warn' ELSE 'error' END,
         '","check":{"function":"is_in_range"},"user_metadata":{"monitor_only":"',
         CASE WHEN p_size > 40 THEN ' TRUE ' ELSE 'false' END, '"}}') END AS {CHECK}
FROM part"""

UNIVERSAL = """SELECT concat('u', CAST(p_partkey AS {TEXT})) AS rule_id,
  CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS rule_fqn,
  CASE WHEN p_size = 50 THEN NULL ELSE CAST(p_size AS INT) END AS version, p_partkey AS updated_at,
  CASE WHEN p_type = 'PROMO' THEN 'draft' WHEN p_type = 'LARGE' THEN 'APPROVED' ELSE 'approved' END AS status,
  concat('{"name":"{{column}}_nn","check":{"function":"is_not_null","arguments":{"column":"$', '{column}",',
         '"columns":"{{columns}}","note":"', p_name, ' of {{columns_csv}} or __COLUMNS__"}}}') AS {CHECK}
FROM part"""

CUSTOMERS = """SELECT c_custkey AS customer_key, c_mktsegment AS segment, c_acctbal AS balance,
  CASE WHEN c_custkey % 47 = 0 THEN '   ' WHEN c_custkey % 59 = 0 THEN NULL ELSE c_name END AS name,
  concat(CASE WHEN c_custkey % 29 = 0 THEN '' ELSE concat(lower(c_mktsegment), '.', CAST(c_custkey AS {TEXT})) END,
         '@example.com') AS email
FROM customer"""


REPLIES = """SELECT CAST(c_custkey AS {TEXT}) AS signature, CASE
  WHEN c_custkey % 5 = 0 THEN concat('no idea about ', c_name)
  WHEN c_custkey % 5 = 1 THEN concat('Sure, {"decision": "', c_name)
  WHEN c_custkey % 5 = 2 THEN replace(concat('As {x} in {"note": {}} and do not {: {~decision~: ~fix~, ~fixes~: [',
    '{~column~: ~code~, ~transform~: ~left_pad~, ~length~: 7, ~pad~: None}], ~confidence~: 0.85, ',
    '~final~: True, ~reasoning~: "None of ', repeat(c_name, 300), '"} {"decision": "reject"}'), '~', {QUOTE})
  ELSE concat('Here: ```{"decision":"', CASE WHEN c_acctbal < 0 THEN 'reject' ELSE 'fix' END,
    '","fixes":[{"column":"code","transform":"left_pad","length":', CAST(c_nationkey AS {TEXT}),
    '}],"confidence":', CASE WHEN c_nationkey > 12 THEN '0.5' ELSE '0.9' END, ',"reasoning":"', c_mktsegment, '"}``` ok') END AS reply
FROM customer"""


TARGETS = """SELECT o_custkey AS grp,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 300000 THEN 'main.silver.other'
       WHEN o_orderpriority <> '5-LOW' OR o_totalprice > 200000 THEN 'main.silver.orders' END AS _data_source,
  CASE WHEN o_custkey % 5 = 0 THEN '' WHEN o_custkey % 7 = 0 AND o_orderstatus = 'P' THEN 'id2'
       ELSE 'customer_id, order_id' END AS _row_id_keys,
  o_totalprice > 480000 AS _is_cross_table FROM orders"""


# --- rules, playbook and proposals of the derived order table ---------------------------------

FQN = "main.quarantine.silver_orders"
SOURCE = "main.silver.orders"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def check(name, function, criticality="error", **arguments):
    return {
        "name": name,
        "criticality": criticality,
        "check": {"function": function, "arguments": arguments},
    }


CHECKS = [
    check("customer_id_is_null", "is_not_null", column="customer_id"),
    check("code_not_matching_regex", "matches_regex", column="code", pattern="^[0-9]{5}$"),
    check("status_is_not_in_the_list", "is_in_list", column="status", allowed=["F", "O", "P"]),
    check("amount_not_positive", "is_in_range", "warn", column="amount", min=0),
    check("priority_not_standard", "is_in_list", "warn", column="priority", allowed=PRIORITIES),
]

ENTRIES = [
    {"rule_name": "code_not_matching_regex", "priority": 5, "strategy": "reject_rows",
     "params": {"reason": "REPLACE_ME"}},
    {"rule_name": "amount_not_positive", "priority": 6, "strategy": "ask_someone", "params": {}},
    {"rule_name": "status_is_not_in_the_list", "priority": 10, "where": "status = 'Invalid'",
     "strategy": "reject_rows", "params": {"reason": "status is invalid"}},
    {"rule_name": "status_is_not_in_the_list", "priority": 20, "where": "status = 'Duplicate'",
     "strategy": "dedupe_keep_latest",
     "params": {"partition_by": ["customer_id"], "order_by": "updated_at", "order_direction": "desc"}},
    {"rule_name": "priority_not_standard", "priority": 30, "strategy": "standardize_value",
     "params": {"column": "priority", "transform": "upper_trim"}},
    {"rule_name": "customer_id_is_null", "priority": 40, "strategy": "fill_default",
     "params": {"column": "customer_id", "default_expr": "0"}},
    {"rule_name": "amount_not_positive", "priority": 50, "where": "code rlike '^A'",
     "strategy": "reject_rows", "params": {}, "match_fqns": ["main.quarantine.other"]},
]


def at(day: int):
    """A fixed time, in place of the clock."""
    return F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")


def passes(dirty: DataFrame) -> list[DataFrame]:
    """The same rows validated three times, changed a little in between."""
    return [
        dirty,
        dirty.filter("status <> 'F'").withColumn("amount", F.col("amount") + 1),
        dirty.filter("priority = '1-URGENT'").withColumn(
            "customer_id", F.coalesce("customer_id", F.lit(0))
        ),
    ]


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantine rows of three append passes."""
    dirty = frame(spark, sf, "DIRTY")
    out = None
    for day, rows in enumerate(passes(dirty), start=1):
        part = V.validate(rows, CHECKS, SOURCE, "order_id", as_of=at(day))[1]
        out = part if out is None else out.unionByName(part)
    return out


def latest(spark: SparkSession, sf: str) -> DataFrame:
    return Q.latest_quarantined(quarantine(spark, sf))


_FLAGS = {
    "f_cust": ("customer_id_is_null", "customer_id IS NULL"),
    "f_code": ("code_not_matching_regex", "NOT regexp_matches(code, '^[0-9]{5}$')"),
    "f_status": ("status_is_not_in_the_list", "status NOT IN ('F', 'O', 'P')"),
    "f_amount": ("amount_not_positive", "amount < 0"),
    "f_priority": (
        "priority_not_standard",
        "priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')",
    ),
}
ERRORS = ("f_cust", "f_code", "f_status")
WARNINGS = ("f_amount", "f_priority")


def failed_names(flags) -> str:
    """SQL for the names of the failed checks, in check order."""
    return "concat_ws('|', " + ", ".join(
        f"CASE WHEN {f} THEN '{_FLAGS[f][0]}' END" for f in flags
    ) + ")"


FLAG_COLUMNS = ", ".join(f"coalesce({test}, FALSE) AS {f}" for f, (_, test) in _FLAGS.items())


def prelude(*more: str) -> str:
    """WITH clause shared by the checking queries."""
    parts = [
        f"dirty AS ({sql('DIRTY')})",
        f"silver AS ({sql('SILVER')})",
        f"flags AS (SELECT *, {FLAG_COLUMNS} FROM dirty)",
        """pass_rows AS (
  SELECT *, 1 AS pass FROM dirty
  UNION ALL SELECT * REPLACE (amount + 1 AS amount), 2 AS pass FROM dirty WHERE status <> 'F'
  UNION ALL SELECT * REPLACE (coalesce(customer_id, 0) AS customer_id), 3 AS pass
    FROM dirty WHERE priority = '1-URGENT')""",
        f"pass_flags AS (SELECT *, {FLAG_COLUMNS} FROM pass_rows)",
        f"""quarantine AS (
  SELECT *, {failed_names(ERRORS)} AS errors, {failed_names(WARNINGS)} AS warnings,
    {failed_names(_FLAGS)} AS violations, sha256(CAST(order_id AS VARCHAR)) AS row_id
  FROM pass_flags WHERE {' OR '.join(_FLAGS)})""",
        """latest AS (
  SELECT *, array_to_string(list_sort(string_split(violations, '|')), '|') AS signature
  FROM quarantine QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY pass DESC) = 1)""",
        *more,
    ]
    return "WITH " + ",\n".join(parts) + "\n"
