"""Patching, re-validation, merging, metrics, reports and whole passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators import curate, metrics, playbook, reingest
from mendflow.operators import queue as Q
from mendflow.plans import dryrun, remediation
from mendflow.sources import tables
from mendflow.streaming import validate_stream as VS
from workloads import fixtures as X
from workloads.curation_queries import REST, ROUTED, _usable
from workloads.registry import day, joined, names, query

QUEUE = f"WITH queue AS ({X.sql('QUEUE')})\n"


# --- merge target ---------------------------------------------------------------------------------

@query(f"""WITH t AS ({X.sql('TARGETS')}), g AS (SELECT grp, count(DISTINCT _data_source) AS ns, min(_data_source) AS s,
  count(DISTINCT _row_id_keys) AS nk, min(_row_id_keys) AS k, bool_or(_is_cross_table) AS c FROM t GROUP BY grp)
SELECT grp, CASE WHEN c THEN 'cross_table_quarantine' WHEN ns = 0 THEN 'no_data_source'
  WHEN ns > 1 THEN 'ambiguous_data_source' WHEN nk <> 1 OR k = '' THEN 'no_business_key_for_merge' END AS reason,
  NOT c AND ns = 1 AND nk = 1 AND k <> '' AS reingestable,
  CASE WHEN ns = 1 THEN s END AS silver_fqn, replace(replace(k, ' ', ''), ',', '|') AS merge_keys FROM g""")
def reingest_target(spark, sf):
    found = reingest.reingest_target(X.frame(spark, sf, "TARGETS"), ["grp"])
    return found.select("grp", "reason", "reingestable", "silver_fqn", joined("merge_keys").alias("merge_keys"))


# --- queue moves ----------------------------------------------------------------------------------

@query(QUEUE + """SELECT review_id, status FROM queue WHERE (status = 'curated' AND confidence >= 0.8)
  OR (status = 'revalidated_fail' AND retry_count < 3) OR status = 'revalidated_pass'""")
def actionable(spark, sf):
    return Q.actionable(X.frame(spark, sf, "QUEUE")).select("review_id", "status")


@query(QUEUE + """, o AS (SELECT review_id, CASE WHEN remediation_action = 'drop' THEN 'removed'
    WHEN remediation_action = 'keep' THEN 'fail' WHEN confidence < 0.8 THEN 'not_mergeable'
    WHEN retry_count = 0 THEN 'merged' ELSE 'pass' END AS outcome,
    status IN ('curated', 'revalidated_pass', 'revalidated_fail') AND remediation_source IS NOT NULL AS moved FROM queue)
SELECT review_id, CASE WHEN NOT moved THEN status WHEN outcome = 'removed' THEN 'resolved_removed'
    WHEN outcome = 'fail' THEN 'revalidated_fail' WHEN outcome = 'not_mergeable' THEN 'escalated'
    WHEN outcome = 'merged' THEN 'reingested' ELSE 'revalidated_pass' END AS status,
  (retry_count + CASE WHEN moved AND outcome = 'fail' THEN 1 ELSE 0 END)::INTEGER AS retry_count,
  CASE WHEN moved THEN 'run9' ELSE last_run_id END AS last_run_id
FROM queue JOIN o USING (review_id)""")
def advance_queue(spark, sf):
    queue = X.frame(spark, sf, "QUEUE").withColumn("updated_at", X.at(1))
    outcome = (
        F.when(F.col("remediation_action") == "drop", "removed")
        .when(F.col("remediation_action") == "keep", "fail")
        .when(F.col("confidence") < 0.8, "not_mergeable")
        .when(F.col("retry_count") == 0, "merged")
        .otherwise("pass")
    )
    outcomes = queue.filter("remediation_source is not null").select(
        "quarantine_fqn", "row_id", outcome.alias("outcome")
    )
    moved = Q.advance_queue(queue, outcomes, "run9", X.at(2))
    return moved.select("review_id", "status", "retry_count", "last_run_id")


@query(QUEUE + """SELECT review_id, CASE WHEN status = 'revalidated_fail' AND retry_count >= 3 THEN 'escalated'
  ELSE status END AS status FROM queue""")
def escalate_exhausted(spark, sf):
    queue = X.frame(spark, sf, "QUEUE").withColumn("updated_at", X.at(1))
    return Q.escalate_exhausted(queue, as_of=X.at(2)).select("review_id", "status")


@query(QUEUE + """SELECT quarantine_fqn, count(*) FILTER (WHERE status = 'revalidated_fail' AND retry_count >= 3)
  AS would_escalate FROM queue GROUP BY quarantine_fqn""")
def would_escalate(spark, sf):
    return Q.would_escalate(X.frame(spark, sf, "QUEUE"))


@query(QUEUE + """, after AS (SELECT review_id, CASE WHEN status = 'revalidated_fail' AND retry_count >= 3
    THEN 'escalated' ELSE status END AS new_status FROM queue WHERE quarantine_fqn <> 'main.quarantine.silver_low'),
before AS (SELECT review_id, status AS old_status FROM queue WHERE quarantine_fqn <> 'main.quarantine.silver_high')
SELECT review_id, old_status, new_status, CASE WHEN old_status IS NULL THEN 'insert'
  WHEN new_status IS NULL THEN 'delete' ELSE 'update' END AS change
FROM before FULL OUTER JOIN after USING (review_id) WHERE old_status IS DISTINCT FROM new_status""")
def queue_changes(spark, sf):
    queue = X.frame(spark, sf, "QUEUE").withColumn("updated_at", X.at(1))
    before = Q.reset_queue(queue, "main.quarantine.silver_high")
    after = Q.escalate_exhausted(Q.reset_queue(queue, "main.quarantine.silver_low"), as_of=X.at(2))
    return Q.queue_changes(before, after).select("review_id", "old_status", "new_status", "change")


# --- patch and re-validate ------------------------------------------------------------------------

@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id,
  CASE WHEN status = 'Invalid' THEN customer_id ELSE coalesce(TRY_CAST(code AS BIGINT), customer_id) END AS customer_id,
  CASE WHEN status = 'Invalid' THEN NULL ELSE status END AS status, code,
  status <> 'Invalid' AND TRY_CAST(code AS BIGINT) IS NULL AS cast_failed FROM dirty""")
def apply_patch(spark, sf):
    fix = F.when(
        F.col("status") == "Invalid", F.create_map(F.lit("status"), F.lit(None).cast("string"))
    ).otherwise(F.create_map(F.lit("customer_id"), F.col("code"), F.lit("nowhere"), F.lit("x")))
    rows = X.frame(spark, sf, "DIRTY").withColumn("fix", fix)
    return reingest.apply_patch(rows, "fix").select(
        "order_id", "customer_id", "status", "code", F.col("_cast_failed").alias("cast_failed")
    )


PATCHED = """patched AS (SELECT row_id, order_id, order_ts, updated_at, status, code, amount,
  CASE WHEN entry_idx = 2 THEN trim(upper(priority)) ELSE priority END AS priority,
  CASE WHEN entry_idx = 3 THEN 0 ELSE customer_id END AS customer_id, action
  FROM handled WHERE action IN ('keep', 'patch_fields')),
tested AS (SELECT *, customer_id IS NOT NULL AND regexp_matches(code, '^[0-9]{5}$')
  AND status IN ('F', 'O', 'P') AS passed FROM patched)"""


def _repaired(spark, sf):
    """Playbook results, kept once because several frames are built from them."""
    return tables.cut_lineage(playbook.apply_playbook(X.latest(spark, sf), _usable()))


def _patched(spark, sf, done=None):
    """Playbook repairs applied to the rows they keep."""
    done = playbook.apply_playbook(X.latest(spark, sf), _usable()) if done is None else done
    fixed = done.filter(F.col("remediation_action").isin("keep", "patch_fields"))
    columns = S.data_columns(X.frame(spark, sf, "DIRTY"))
    return reingest.apply_patch(fixed.select("row_id", *columns, "action_payload"), "action_payload", columns)


@query(X.prelude(ROUTED, PATCHED) + """SELECT row_id, order_id, customer_id, priority, passed,
  concat_ws('|', CASE WHEN customer_id IS NULL THEN 'customer_id_is_null' END,
    CASE WHEN NOT regexp_matches(code, '^[0-9]{5}$') THEN 'code_not_matching_regex' END,
    CASE WHEN status NOT IN ('F', 'O', 'P') THEN 'status_is_not_in_the_list' END) AS errors FROM tested""")
def revalidate(spark, sf):
    done = reingest.revalidate(_patched(spark, sf), X.CHECKS)
    return done.select("row_id", "order_id", "customer_id", "priority", "passed", names("_error").alias("errors"))


UNIQUE = X.check("one_per_day", "is_unique", columns=["customer_id", "order_ts"])


@query(f"""WITH dirty AS ({X.sql('DIRTY')}), silver AS ({X.sql('SILVER')}),
cand AS (SELECT * FROM dirty WHERE amount < 0 OR status = 'Duplicate'),
everything AS (SELECT customer_id, order_ts FROM cand
  UNION ALL SELECT customer_id, order_ts FROM silver WHERE order_id NOT IN (SELECT order_id FROM cand)),
n AS (SELECT customer_id, order_ts, count(*) AS n FROM everything GROUP BY ALL)
SELECT c.order_id, coalesce(n.n, 1) = 1 AS passed FROM cand c
LEFT JOIN n ON n.customer_id = c.customer_id AND n.order_ts = c.order_ts""")
def revalidate_against_target(spark, sf):
    cand = X.frame(spark, sf, "DIRTY").filter("amount < 0 OR status = 'Duplicate'")
    cand = cand.withColumn("row_id", F.sha2(F.col("order_id").cast("string"), 256))
    done = reingest.revalidate(cand, [UNIQUE], against=X.frame(spark, sf, "SILVER"), keys=["order_id"])
    return done.select("order_id", "passed")


# --- merge ----------------------------------------------------------------------------------------

STAGED = """staged AS (SELECT order_id, customer_id, updated_at, priority, amount, false AS agent_curated,
  1.0::DOUBLE AS confidence FROM tested WHERE passed AND customer_id IS NOT NULL)"""


def _staged(spark, sf):
    done = _repaired(spark, sf)
    rows = reingest.revalidate(_patched(spark, sf, done), X.CHECKS).drop("order_ts", "status", "code")
    queue = playbook.playbook_updates(done, X.FQN, "run1", X.at(4))
    return tables.cut_lineage(reingest.with_lineage(reingest.stage(rows, queue), "run1", X.at(4)))


@query(X.prelude(ROUTED, PATCHED, STAGED) + """SELECT order_id, customer_id, priority, amount, agent_curated,
  confidence, 'run1' AS reingest_run_id, '2024-01-04' AS reingested_on FROM staged""")
def stage_with_lineage(spark, sf):
    return _staged(spark, sf).select(
        "order_id", "customer_id", "priority", "amount", "agent_curated", "confidence", "reingest_run_id",
        day("reingested_at").alias("reingested_on"),
    )


@query(X.prelude(ROUTED, PATCHED, STAGED) + """SELECT order_id, amount,
  CASE WHEN order_id IN (SELECT order_id FROM silver) THEN 'update' ELSE 'insert' END AS merge_action FROM staged""")
def merge_split(spark, sf):
    silver = X.frame(spark, sf, "SILVER")
    aligned, _ = reingest.align_to_target(_staged(spark, sf), silver, ["order_id"])
    return reingest.merge_split(aligned, silver, ["order_id"]).select("order_id", "amount", "merge_action")


@query(X.prelude(ROUTED, PATCHED, STAGED) + """SELECT
  count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM silver)) AS would_insert,
  count(*) FILTER (WHERE order_id IN (SELECT order_id FROM silver)) AS would_update FROM staged""")
def merge_dry_run(spark, sf):
    silver = X.frame(spark, sf, "SILVER")
    aligned, _ = reingest.align_to_target(_staged(spark, sf), silver, ["order_id"])
    return reingest.merge_counts(reingest.merge_split(aligned, silver, ["order_id"]))


MERGED = """merged AS (
  SELECT t.order_id, CASE WHEN s.order_id IS NULL THEN t.customer_id ELSE s.customer_id END AS customer_id,
    CASE WHEN s.order_id IS NULL THEN t.priority ELSE s.priority END AS priority,
    CASE WHEN s.order_id IS NULL THEN t.amount ELSE s.amount END AS amount,
    t.status, t.code, s.agent_curated, s.confidence, t.channel
  FROM silver t LEFT JOIN staged s USING (order_id)
  UNION ALL SELECT order_id, customer_id, priority, amount, NULL, NULL, agent_curated, confidence, NULL
  FROM staged WHERE order_id NOT IN (SELECT order_id FROM silver))"""


@query(X.prelude(ROUTED, PATCHED, STAGED, MERGED) + "SELECT * FROM merged")
def merge_upsert(spark, sf):
    silver = X.frame(spark, sf, "SILVER")
    aligned, _ = reingest.align_to_target(_staged(spark, sf), silver, ["order_id"])
    return reingest.merge_upsert(silver, aligned, ["order_id"]).select(
        "order_id", "customer_id", "priority", "amount", "status", "code", "agent_curated", "confidence", "channel"
    )


@query(X.prelude(ROUTED, PATCHED, STAGED, MERGED) + "SELECT * FROM merged")
def merge_filtered(spark, sf):
    """The same merge as one whose staged rows are too many to send: range and bitmap of the keys come first."""
    silver = X.frame(spark, sf, "SILVER")
    aligned, _ = reingest.align_to_target(_staged(spark, sf), silver, ["order_id"])
    return reingest.merge_upsert(silver, aligned, ["order_id"], small=False).select(
        "order_id", "customer_id", "priority", "amount", "status", "code", "agent_curated", "confidence", "channel"
    )


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R'),
a AS (SELECT DISTINCT l_orderkey AS o, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'A')
SELECT o, s, count(*) AS n FROM (SELECT o, s FROM l UNION ALL SELECT o, s FROM a WHERE (o, s) NOT IN (SELECT (o, s) FROM l)) GROUP BY o, s""")
def merge_insert_only(spark, sf):
    """Every common column is a key, so nothing is updated."""
    lines = X.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o"), F.col("l_suppkey").alias("s"), "l_returnflag"
    )
    target = lines.filter("l_returnflag = 'R'").select("o", "s").distinct()
    staged = lines.filter("l_returnflag = 'A'").select("o", "s").distinct()
    return reingest.merge_upsert(target, staged, ["o", "s"]).groupBy("o", "s").agg(F.count("*").alias("n"))


@query(f"""WITH dirty AS ({X.sql('DIRTY')}) SELECT order_id, 'null_business_key' AS reason FROM dirty
WHERE customer_id IS NULL OR order_ts IS NULL""")
def null_key_rows(spark, sf):
    rows = reingest.null_key_rows(X.frame(spark, sf, "DIRTY"), ["customer_id", "order_ts"])
    return rows.select("order_id", F.lit("null_business_key").alias("reason"))


# --- metrics --------------------------------------------------------------------------------------

@query(QUEUE + "SELECT quarantine_fqn, run_id, status, count(*) AS n_rows FROM queue GROUP BY ALL")
def status_counts(spark, sf):
    return metrics.status_counts(X.frame(spark, sf, "QUEUE"))


COUNTS = """counts AS (SELECT quarantine_fqn, count(*) FILTER (WHERE run_id = 'run2') AS triaged,
  count(*) FILTER (WHERE last_run_id = 'run2' AND remediation_source = 'playbook') AS by_playbook,
  count(*) FILTER (WHERE last_run_id = 'run2' AND status = 'reingested') AS reingested,
  count(*) FILTER (WHERE last_run_id = 'run2' AND status = 'escalated') AS escalated,
  count(*) FILTER (WHERE last_run_id = 'run2' AND status = 'revalidated_fail') AS failing,
  count(*) FILTER (WHERE last_run_id = 'run2' AND status IN ('escalated', 'rejected')) AS errors
FROM queue WHERE run_id = 'run2' OR last_run_id = 'run2' GROUP BY quarantine_fqn)"""


@query(QUEUE + f""", {COUNTS} SELECT 'run2' AS run_id, quarantine_fqn, triaged AS triaged_count,
  by_playbook AS playbook_resolved_count, reingested AS reingested_count, escalated AS escalated_count,
  reingested / nullif(triaged, 0) AS reingest_rate FROM counts""")
def audit_row(spark, sf):
    return metrics.audit_row(X.frame(spark, sf, "QUEUE"), "run2", X.at(1)).drop("run_at")


@query(QUEUE + f""", {COUNTS} SELECT 'reingest' AS metric_source, quarantine_fqn AS table_fqn,
  'run2' AS run_id, triaged AS input_row_count, reingested AS passed_row_count,
  failing + escalated AS failed_row_count, errors AS error_row_count, 0::BIGINT AS warning_row_count FROM counts""")
def summary_metrics(spark, sf):
    return metrics.summary_metrics(X.frame(spark, sf, "QUEUE"), "run2", as_of=X.at(1)).drop("run_at")


RESOLVED = """resolved AS (SELECT DISTINCT row_id FROM queue WHERE quarantine_fqn = 'main.quarantine.silver_low'
  AND status IN ('reingested', 'resolved_duplicate', 'resolved_removed', 'rejected'))"""
WAITING = f"""waiting AS (SELECT DISTINCT row_id FROM queue WHERE quarantine_fqn = 'main.quarantine.silver_low'
  AND status <> 'pending')"""
QUEUE_CTE = f"queue AS ({X.sql('QUEUE')})"
LOW = "main.quarantine.silver_low"


@query(X.prelude(QUEUE_CTE, RESOLVED, WAITING) + """SELECT (SELECT count(*) FROM latest) AS quarantined_rows,
  (SELECT count(*) FROM resolved) AS already_resolved,
  (SELECT count(*) FROM latest WHERE row_id NOT IN (SELECT row_id FROM waiting)) AS pending_rows""")
def remaining_work(spark, sf):
    return metrics.remaining_work(X.latest(spark, sf), X.frame(spark, sf, "QUEUE"), LOW)


DRY_ROUTED = ROUTED.replace(
    "FROM latest)", "FROM latest WHERE row_id NOT IN (SELECT row_id FROM waiting))"
)


@query(X.prelude(QUEUE_CTE, RESOLVED, WAITING, DRY_ROUTED, PATCHED) + f"""SELECT 'run5' AS run_id, '{LOW}' AS quarantine_fqn,
  'main.silver.orders' AS silver_fqn, (SELECT count(*) FROM latest) AS quarantined_rows,
  (SELECT count(*) FROM resolved) AS already_resolved, (SELECT count(*) FROM routed) AS pending_rows,
  (SELECT count(*) FROM patched) AS playbook_keep_or_patch,
  (SELECT count(*) FROM handled WHERE action = 'drop') AS playbook_would_drop,
  (SELECT count(*) FROM handled WHERE action = 'reject') AS playbook_would_reject,
  (SELECT count(*) FROM tested WHERE passed) AS playbook_would_pass,
  (SELECT count(*) FROM tested WHERE NOT passed) AS playbook_would_fail,
  (SELECT count(*) FROM routed WHERE entry_idx IS NULL) AS agent_eligible, 0::BIGINT AS not_reingestable,
  (SELECT count(*) FROM tested WHERE passed AND order_id NOT IN (SELECT order_id FROM silver)) AS est_reingest_insert,
  (SELECT count(*) FROM tested WHERE passed AND order_id IN (SELECT order_id FROM silver)) AS est_reingest_update""")
def dry_run_report(spark, sf):
    entries = [{k: v for k, v in e.items() if k != "match_fqns"} for e in X.ENTRIES[:-1]]
    return dryrun.dry_run_report(
        X.quarantine(spark, sf), X.frame(spark, sf, "QUEUE"), X.frame(spark, sf, "SILVER"), entries, X.CHECKS,
        LOW, ["order_id"], "run5", as_of=X.at(5),
    ).drop("run_at")


# --- whole pass -----------------------------------------------------------------------------------

FINAL = """fixed_code AS (SELECT *, lpad(regexp_replace(code, '^[A-Za-z]+', ''), 5, '0') AS new_code FROM rest),
chosen AS (SELECT row_id, signature, CASE WHEN signature = 'code_not_matching_regex' THEN 'fix' ELSE 'escalate' END AS decision,
  new_code FROM fixed_code),
statuses AS (
  SELECT h.row_id, 'playbook' AS source, h.action, CASE h.action WHEN 'drop' THEN 'resolved_duplicate'
    WHEN 'reject' THEN 'rejected' ELSE CASE WHEN t.passed THEN 'reingested' ELSE 'revalidated_fail' END END AS status,
    CASE WHEN t.passed IS FALSE THEN 1 ELSE 0 END AS retries
  FROM handled h LEFT JOIN tested t USING (row_id)
  UNION ALL SELECT row_id, 'agent', CASE WHEN decision = 'fix' THEN 'patch_fields' END,
    CASE WHEN decision = 'fix' THEN 'reingested' ELSE 'escalated' END, 0 FROM chosen)"""


def _pass(spark, sf):
    return remediation.remediate(
        X.quarantine(spark, sf), spark.createDataFrame([], S.QUEUE_DDL), X.frame(spark, sf, "SILVER"),
        X.FQN, "run1", X.ENTRIES, X.CHECKS, ["order_id"], as_of=X.at(4),
    )


@query(X.prelude(ROUTED, PATCHED, REST, FINAL) + """SELECT row_id, source, action, status, retries::INTEGER AS retry_count FROM statuses""")
def remediation_queue(spark, sf):
    return _pass(spark, sf).queue.select(
        "row_id", F.col("remediation_source").alias("source"), F.col("remediation_action").alias("action"),
        "status", "retry_count",
    )


@query(X.prelude(ROUTED, PATCHED, REST, FINAL, """staged AS (
  SELECT order_id, customer_id, priority, amount, code, status, false AS agent_curated, 1.0::DOUBLE AS confidence
    FROM tested WHERE passed
  UNION ALL SELECT r.order_id, r.customer_id, r.priority, r.amount, c.new_code, r.status, true, 0.95::DOUBLE
    FROM rest r JOIN chosen c USING (row_id) WHERE c.decision = 'fix')""") + """
SELECT order_id, s.customer_id, s.priority, s.amount, s.code, s.status, s.agent_curated, s.confidence, t.channel
FROM staged s LEFT JOIN silver t USING (order_id)
UNION ALL SELECT order_id, customer_id, priority, amount, code, status, agent_curated, confidence, channel
FROM silver WHERE order_id NOT IN (SELECT order_id FROM staged)""")
def remediation_silver(spark, sf):
    return _pass(spark, sf).silver.select(
        "order_id", "customer_id", "priority", "amount", "code", "status", "agent_curated", "confidence", "channel"
    )


# --- streaming ------------------------------------------------------------------------------------

@query(X.prelude() + f"""SELECT 'valid' AS side, order_id, '' AS errors, '' AS warnings FROM flags
WHERE NOT ({' OR '.join(X.ERRORS)})
UNION ALL SELECT 'invalid', order_id, {X.failed_names(X.ERRORS)}, {X.failed_names(X.WARNINGS)}
FROM flags WHERE {' OR '.join(X.ERRORS + X.WARNINGS)}""")
def stream_validate(spark, sf):
    folder = tables.scratch_folder(spark)
    schema = X.table(spark, sf, "orders").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    stream.createOrReplaceTempView("orders")
    dirty = spark.sql(X._fill(X.DIRTY, "spark"))
    sink = VS.partitioned_sink(f"{folder}/valid", f"{folder}/quarantine")
    running = VS.validate_stream(
        dirty, X.CHECKS, X.SOURCE, sink, f"{folder}/checkpoint", "order_id", as_of=X.at(1)
    )
    running.awaitTermination()
    valid, bad = (spark.read.parquet(f"{folder}/{side}") for side in ("valid", "quarantine"))
    good = valid.select(
        F.lit("valid").alias("side"), "order_id", F.lit("").alias("errors"), F.lit("").alias("warnings")
    )
    return good.unionAll(bad.select(F.lit("invalid"), "order_id", names("_error"), names("_warning")))
