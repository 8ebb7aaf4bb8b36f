"""Stored tables, merges and whole passes: what is written is read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators import checks as C
from mendflow.operators import keychecks, reingest
from mendflow.operators import validate as V
from mendflow.operators.history import KeyHistory
from mendflow.plans import dryrun, remediation, triage
from mendflow.plans.validation import Validator
from mendflow.sources import playbooks, rules, tables
from workloads import fixtures as X
from workloads.curation_queries import ROUTED
from workloads.registry import joined, names, query
from workloads.reingest_queries import PATCHED

DIRTY = f"WITH dirty AS ({X.sql('DIRTY')})\n"


def _stored(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """Run ``work`` on a catalog of its own; its result is kept and its tables are dropped."""
    catalog = f"q{uuid.uuid4().hex}"
    try:
        return tables.cut_lineage(work(catalog))
    finally:
        for row in spark.sql(f"SHOW SCHEMAS LIKE '{catalog}*'").collect():
            spark.sql(f"DROP SCHEMA `{row[0]}` CASCADE")
        tables.delete_folder(spark, f"{tables._root(spark)}/{catalog}")


# --- checks ---------------------------------------------------------------------------------------

@query(DIRTY + """SELECT order_id, 'null_in_list' AS failed FROM dirty WHERE status NOT IN ('F', 'O')
UNION ALL SELECT order_id, 'empty_list' FROM dirty WHERE priority IS NOT NULL""")
def check_in_list_nulls(spark, sf):
    checks = [
        X.check("null_in_list", "is_in_list", column="status", allowed=["F", None, "O"]),
        X.check("empty_list", "is_in_list", column="priority", allowed=[]),
    ]
    bad = C.split(X.frame(spark, sf, "DIRTY"), checks)[1]
    return bad.select("order_id", F.explode("_error").alias("e")).select("order_id", F.col("e.name").alias("failed"))


@query(f"""WITH customers AS ({X.sql('CUSTOMERS')}) SELECT customer_key,
  concat_ws('|', CASE WHEN name IS NULL OR trim(name) = '' THEN 'name_set' END,
    CASE WHEN email LIKE '@%' THEN 'email_set' END) AS failed
FROM customers WHERE name IS NULL OR trim(name) = '' OR email LIKE '@%'""")
def universal_evaluate(spark, sf):
    """A template that names the column and all columns tests the column."""
    template = {
        "name": "{{column}}_set",
        "check": {
            "function": "is_not_null_and_not_empty",
            "arguments": {"column": "${column}", "columns": "{{columns}}"},
        },
    }
    customers = X.frame(spark, sf, "CUSTOMERS").withColumn("email", F.split_part("email", F.lit("@"), F.lit(1)))
    bad = V.validate_universal(customers, [template], ["name", "email"], "main.silver.customers", "set", "customer_key")[1]
    return bad.select("customer_key", names("_error").alias("failed"))


@query(DIRTY + """, batches AS (SELECT *, order_id % 5 AS batch FROM dirty),
n AS (SELECT *, count(*) OVER (PARTITION BY customer_id, status) AS all_rows,
  count(*) OVER (PARTITION BY customer_id, status ORDER BY batch) AS rows_so_far FROM batches)
SELECT order_id, batch::BIGINT AS batch, customer_id IS NOT NULL AND status IS NOT NULL AND rows_so_far > 1 AS failed_then,
  customer_id IS NOT NULL AND status IS NOT NULL AND all_rows > 1 AS failed_at_last FROM n""")
def unique_across_batches(spark, sf):
    """Five batches against kept key counts: what fails in its batch, and with rows taken back later, as over the union."""
    check = C.parse_check(X.check("one_order", "is_unique", columns=["customer_id", "status"], history="orders"))

    def work(catalog: str) -> DataFrame:
        history = KeyHistory(spark, f"{catalog}.gov.seen_orders", buckets=4, merge_after=2)
        dirty = X.frame(spark, sf, "DIRTY").select("order_id", "customer_id", "status")
        marked, taken_back = [], []
        for batch in range(5):
            rows = dirty.filter(F.col("order_id") % 5 == batch)
            seen = history.at(batch)
            keys = keychecks.unique_keys(rows, check)
            failing = C.evaluate(rows, [check], {"orders": seen})
            marked.append(failing.select("*", F.lit(batch).cast("long").alias("batch")))
            taken_back.append(seen.repeated_now(keys).withColumn("by", F.lit(batch)))
            marked[-1], taken_back[-1] = tables.cut_lineage(marked[-1]), tables.cut_lineage(taken_back[-1])
            seen.record(keys)
            if batch == 3:
                seen.record(keys)  # delivered again
        rows, late = marked[0], taken_back[0]
        for i in range(1, 5):
            rows, late = rows.unionByName(marked[i]), late.unionByName(taken_back[i])
        then = F.col("_error").isNotNull()
        back = late.select("k1", "k2").distinct().withColumn("back", F.lit(True))
        keyed = rows.withColumns({f"k{i + 1}": x for i, x in enumerate(keychecks.digest([F.col("customer_id"), F.col("status")]))})
        return keyed.join(back, ["k1", "k2"], "left").select(
            "order_id", "batch", then.alias("failed_then"), (then | F.coalesce("back", F.lit(False))).alias("failed_at_last")
        )

    return _stored(spark, work)


@query(DIRTY + f""", silver AS ({X.sql('SILVER')}), c AS (SELECT c_custkey AS known FROM customer WHERE c_custkey % 11 <> 0),
f AS (SELECT d.order_id,
  count(*) OVER (PARTITION BY d.customer_id, d.status) > 1 AND d.customer_id IS NOT NULL AND d.status IS NOT NULL AS pair,
  count(*) OVER (PARTITION BY lower(d.priority), floor(d.amount)) > 1 AS prio,
  d.customer_id IS NOT NULL AND known IS NULL AS orphan,
  s.order_id IS NOT NULL AND s.amount IS DISTINCT FROM d.amount AS differs
  FROM dirty d LEFT JOIN c ON known = d.customer_id LEFT JOIN silver s ON s.order_id = d.order_id)
SELECT order_id, concat_ws('|', CASE WHEN pair THEN 'pair' END, CASE WHEN prio THEN 'prio' END,
  CASE WHEN orphan THEN 'orphan' END, CASE WHEN differs THEN 'differs' END) AS failed
FROM f WHERE pair OR prio OR orphan OR differs""")
def check_keys_together(spark, sf):
    """Two uniqueness checks, a foreign key and a comparison: one count of all their keys."""
    customers = X.table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("customer_id")).filter("customer_id % 11 <> 0")
    refs = {"customers": customers, "orders": X.frame(spark, sf, "SILVER").select("order_id", "amount")}
    checks = [
        X.check("pair", "is_unique", columns=["customer_id", "status"]),
        X.check("prio", "is_unique", columns=["priority", "whole"], ci_columns=["priority"], nulls_distinct=False),
        X.check("orphan", "foreign_key", column="customer_id", ref_table="customers", ref_column="customer_id"),
        X.check("differs", "sql_query", compare_column="amount", other_table="orders", join_keys=["order_id"]),
    ]
    rows = X.frame(spark, sf, "DIRTY").withColumn("whole", F.floor("amount"))
    return C.split(rows, checks, refs)[1].select("order_id", names("_error").alias("failed"))


# --- patch and merge ------------------------------------------------------------------------------

@query(DIRTY + """SELECT order_id, CASE order_id % 4 WHEN 0 THEN 'x|' || priority ELSE status END AS tags,
  CASE order_id % 4 WHEN 2 THEN order_id + 1 ELSE order_id END AS a,
  order_id % 4 = 1 OR order_id % 4 = 3 AS cast_failed FROM dirty""")
def apply_patch_nested(spark, sf):
    kind = F.col("order_id") % 4
    fix = (
        F.when(kind == 0, F.create_map(F.lit("tags"), F.to_json(F.array(F.lit("x"), "priority"))))
        .when(kind == 1, F.create_map(F.lit("tags"), F.lit('["unclosed"')))
        .when(kind == 2, F.create_map(F.lit("place"), F.concat(F.lit('{"a": '), (F.col("order_id") + 1).cast("string"), F.lit("}"))))
        .otherwise(F.create_map(F.lit("place"), F.lit("[]")))
    )
    rows = X.frame(spark, sf, "DIRTY").select(
        "order_id", F.array("status").alias("tags"), F.struct(F.col("order_id").alias("a")).alias("place"), fix.alias("fix")
    )
    done = reingest.apply_patch(rows, "fix")
    return done.select("order_id", joined("tags").alias("tags"), "place.a", F.col("_cast_failed").alias("cast_failed"))


STAGED_TENTH = "staged AS (SELECT order_id, amount, status FROM dirty WHERE order_id % 10 = 0 AND status <> 'Invalid')"


@query(DIRTY + f""", silver AS ({X.sql('SILVER')}), {STAGED_TENTH}
SELECT s.order_id, s.amount, s.status, t.channel FROM staged s LEFT JOIN silver t USING (order_id)
UNION ALL SELECT order_id, amount, status, channel FROM silver WHERE order_id NOT IN (SELECT order_id FROM staged)""")
def merge_partitioned(spark, sf):
    """A table partitioned by status takes a merge that moves rows and opens partitions."""
    def work(catalog: str) -> DataFrame:
        fqn = f"{catalog}.silver.orders"
        name = tables.table_name(spark, fqn)
        spark.sql(f"CREATE SCHEMA {name.rsplit('.', 1)[0]}")
        spark.sql(f"CREATE TABLE {name} (order_id BIGINT, amount DOUBLE, channel STRING, status STRING) "
                  "USING parquet PARTITIONED BY (status)")
        tables.replace(X.frame(spark, sf, "SILVER").select("order_id", "amount", "channel", "status"), fqn)
        silver = tables.read(spark, fqn)
        staged = X.frame(spark, sf, "DIRTY").filter("order_id % 10 = 0 AND status <> 'Invalid'")
        staged = staged.select("order_id", "amount", "status")
        touched = tables.cut_lineage(reingest.touched_partitions(silver, staged, ["order_id"], ["status"]))
        here = reingest.in_partitions(silver, touched, ["status"])
        tables.replace_partitions(reingest.merge_upsert(here, staged, ["order_id"]), fqn, touched)
        return tables.read(spark, fqn).select("order_id", "amount", "status", "channel")

    return _stored(spark, work)


@query(DIRTY + """, n AS (SELECT *, regexp_matches(code, '^[0-9]{5}$') AS ok,
  count(*) FILTER (WHERE regexp_matches(code, '^[0-9]{5}$')) OVER (PARTITION BY customer_id) AS n FROM dirty)
SELECT order_id, CASE WHEN NOT ok THEN 'fail' WHEN customer_id IS NULL OR n > 1 THEN 'not_mergeable' ELSE 'merged' END AS outcome
FROM n""")
def merge_repeated_keys(spark, sf):
    rows = X.frame(spark, sf, "DIRTY").withColumns(
        {"row_id": F.col("order_id").cast("string"), "passed": F.col("code").rlike("^[0-9]{5}$")}
    )
    return reingest.judge(rows, ["customer_id"], "merged").select("order_id", "outcome")


# --- dry run and passes ---------------------------------------------------------------------------

@query(X.prelude(ROUTED, PATCHED) + """, n AS (SELECT
  count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM silver)) AS i,
  count(*) FILTER (WHERE order_id IN (SELECT order_id FROM silver)) AS u FROM tested WHERE passed)
SELECT i AS dry_insert, i AS run_insert, u AS dry_update, u AS run_update FROM n""")
def dry_run_equals_run(spark, sf):
    quarantine, silver = X.quarantine(spark, sf), X.frame(spark, sf, "SILVER")
    nothing = spark.createDataFrame([], S.PROPOSAL_DDL)
    dry = dryrun.dry_run_report(quarantine, None, silver, X.ENTRIES, X.CHECKS, X.FQN, ["order_id"], as_of=X.at(4))
    run = remediation.remediate(
        quarantine, spark.createDataFrame([], S.QUEUE_DDL), silver, X.FQN, "run1", X.ENTRIES, X.CHECKS,
        ["order_id"], propose=lambda rows: nothing, as_of=X.at(4),
    )
    real = reingest.merge_counts(run.merge_split)
    both = dry.select(
        F.col("est_reingest_insert").alias("dry_insert"), F.col("est_reingest_update").alias("dry_update")
    ).unionByName(
        real.select(F.col("would_insert").alias("run_insert"), F.col("would_update").alias("run_update")),
        allowMissingColumns=True,
    )
    return both.agg(*[F.max(c).alias(c) for c in ("dry_insert", "run_insert", "dry_update", "run_update")])


@query(DIRTY + """SELECT order_id, 'reingested' AS status, trim(upper(priority)) AS priority FROM dirty
WHERE order_id % 43 = 0""")
def remediation_with_probe(spark, sf):
    """Mismatches with another table are resolved by the probe, checked again and merged."""
    orders = X.table(spark, sf, "orders")
    refs = {"main.ref.orders": orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"))}
    check = X.check("same_priority", "sql_query", compare_column="priority", other_table="main.ref.orders", join_keys=["order_id"])
    bad = V.validate(X.frame(spark, sf, "DIRTY"), [check], X.SOURCE, "order_id", refs, as_of=X.at(1))[1]
    done = remediation.remediate(
        bad, spark.createDataFrame([], S.QUEUE_DDL), X.frame(spark, sf, "SILVER"), X.FQN, "run1", [], [check], ["order_id"],
        refs=refs, probes={"same_priority": remediation.Probe("priority", "main.ref.orders", ["order_id"], ("upper_trim",))},
        as_of=X.at(4),
    )
    ids = bad.select(F.col("_row_id").alias("row_id"), "order_id")
    states = done.queue.select("row_id", "status").join(ids, "row_id")
    return states.join(done.silver.select("order_id", "priority"), "order_id").select("order_id", "status", "priority")


@query(DIRTY + """, bad AS (SELECT order_id % 2 AS part, code, order_id FROM dirty WHERE NOT regexp_matches(code, '^[0-9]{5}$'))
SELECT 'silver_' || part AS name, false AS failed, count(*) AS inserted, count(*) AS reingested FROM bad GROUP BY part
UNION ALL SELECT 'silver_broken', true, 0, 0""")
def process_all_tables(spark, sf):
    """Every quarantine table of a schema is repaired and merged; a broken one stops no other."""
    check = X.check("code_not_matching_regex", "matches_regex", column="code", pattern="^[0-9]{5}$")

    def work(catalog: str) -> DataFrame:
        dirty = X.frame(spark, sf, "DIRTY")
        checks_for = lambda fqn: [check]
        for part in (0, 1):
            source, target = f"{catalog}.silver.t{part}", f"{catalog}.quarantine.silver_{part}"
            rows = dirty.filter(F.col("order_id") % 2 == part)
            tables.append(V.validate(rows, [check], source, "order_id", as_of=X.at(1))[1], target)
            tables.append(rows.limit(0), source)
        tables.append(dirty.limit(0), f"{catalog}.quarantine.silver_broken")
        done = remediation.process_all(
            spark, f"{catalog}.quarantine",
            lambda fqn: remediation.remediate_table(spark, fqn, f"{catalog}.gov.{fqn.rsplit('.', 1)[1]}", "run1", [], checks_for),
            "silver_",
        )
        listed = [
            (o.fqn.rsplit(".", 1)[1], o.error is not None, (o.result or {}).get("inserted", 0), (o.result or {}).get("reingested_count", 0))
            for o in done
        ]
        return spark.createDataFrame(listed, "name string, failed boolean, inserted long, reingested long")

    return _stored(spark, work)


@query(DIRTY + """, bad AS (SELECT order_id % 8 AS part, order_id FROM dirty WHERE NOT regexp_matches(code, '^[0-9]{5}$'))
SELECT 'silver_' || part AS name, count(*) AS queued, count(*) AS reingested, count(*) AS audited FROM bad GROUP BY part""")
def process_all_shared(spark, sf):
    """Eight tables are repaired four at a time; all write to one queue, one audit and one metrics table."""
    check = X.check("code_not_matching_regex", "matches_regex", column="code", pattern="^[0-9]{5}$")

    def work(catalog: str) -> DataFrame:
        dirty = X.frame(spark, sf, "DIRTY")
        checks_for = lambda fqn: [check]
        with tables.scratch(spark):  # the failing rows of all eight are found in one scan
            failing = tables.cut_lineage(C.split(dirty, [check])[1].select(*dirty.columns))
            for part in range(8):
                source, target = f"{catalog}.silver.t{part}", f"{catalog}.quarantine.silver_{part}"
                rows = failing.filter(F.col("order_id") % 8 == part)
                tables.append(V.validate(rows, [check], source, "order_id", as_of=X.at(1))[1], target)
                tables.append(rows.limit(0), source)
        done = remediation.process_all(
            spark, f"{catalog}.quarantine",
            lambda fqn: remediation.remediate_table(
                spark, fqn, f"{catalog}.gov.queue", "run1", [], checks_for,
                audit_fqn=f"{catalog}.gov.audit", metrics_fqn=f"{catalog}.gov.metrics",
            ),
            "silver_",
        )
        failed = [f"{o.fqn}: {o.error}" for o in done if o.error]
        if failed:
            raise RuntimeError("; ".join(failed))
        queue, audit = tables.read(spark, f"{catalog}.gov.queue"), tables.read(spark, f"{catalog}.gov.audit")
        name = F.substring_index("quarantine_fqn", ".", -1).alias("name")
        queued = queue.groupBy(name).agg(F.count("*").alias("queued"), F.count_if(F.col("status") == S.REINGESTED).alias("reingested"))
        return queued.join(audit.groupBy(name).agg(F.sum("triaged_count").alias("audited")), "name")

    return _stored(spark, work)


@query(X.prelude() + """, first AS (SELECT row_id, max(pass) AS pass FROM quarantine WHERE pass < 3 GROUP BY row_id),
third AS (SELECT DISTINCT row_id, order_id FROM quarantine WHERE pass = 3)
SELECT DISTINCT q.order_id, 'run1' AS run_id, f.pass::BIGINT AS pass FROM first f JOIN quarantine q USING (row_id)
UNION ALL SELECT order_id, CASE WHEN order_id % 2 = 0 OR f.row_id IS NULL THEN 'run2' ELSE 'run3' END, 3
FROM third LEFT JOIN first f USING (row_id)""")
def triage_incremental(spark, sf):
    """Three passes of triage, each over the appends it has not done with; rows still open wait for the third."""
    def work(catalog: str) -> DataFrame:
        fqn, marks = f"{catalog}.quarantine.silver_orders", f"{catalog}.gov.marks"
        rows, queue = X.quarantine(spark, sf), spark.createDataFrame([], S.QUEUE_DDL)

        def run(run_id: str, queue: DataFrame) -> DataFrame:
            found = triage.triage_changes(spark, fqn, queue, marks, run_id, X.at(4), "newer")
            after = tables.cut_lineage(queue.unionByName(found.new))
            found.done(after)
            return after

        for i in (1, 2):
            tables.append(rows.filter(F.col("_generated_at") == X.at(i)), fqn)
        queue = run("run1", queue)
        tables.append(rows.filter(F.col("_generated_at") == X.at(3)), fqn)
        ids = tables.cut_lineage(rows.select(F.col("_row_id").alias("row_id"), "order_id").distinct())
        even = ids.filter("order_id % 2 = 0").select("row_id", F.lit(True).alias("even"))
        closed = F.when(F.col("even"), S.REINGESTED).otherwise(F.col("status"))
        queue = queue.join(even, "row_id", "left").withColumn("status", closed).drop("even").select(*queue.columns)
        queue = run("run2", tables.cut_lineage(queue))
        queue = run("run3", tables.cut_lineage(queue.withColumn("status", F.lit(S.REINGESTED))))
        at = F.dayofmonth("quarantine_generated_at").cast("long")
        return queue.join(ids, "row_id").select("order_id", "run_id", at.alias("pass"))

    return _stored(spark, work)


# --- sources and sinks ----------------------------------------------------------------------------

@query("""SELECT DISTINCT 'quarantine.silver_' || lower(o_orderstatus) AS name FROM orders""")
def discover_tables(spark, sf):
    """Quarantine tables by prefix; staged tables and other names are left out."""
    def work(catalog: str) -> DataFrame:
        orders = X.table(spark, sf, "orders")
        kinds = [r[0].lower() for r in orders.select("o_orderstatus").distinct().collect()]
        for name in [*(f"silver_{k}" for k in kinds), f"silver_{kinds[0]}{S.STAGED_SUFFIX}", "bronze_x"]:
            tables.append(orders.filter(F.lower("o_orderstatus") == name[7]), f"{catalog}.quarantine.{name}")
        found = tables.discover(spark, f"{catalog}.quarantine", "silver_")
        return found.select(F.substring_index("fqn", ".", -2).alias("name"))

    return _stored(spark, work)


@query(f"""WITH rules AS ({X.sql('RULES')}), good AS (SELECT rule_id, table_fqn, "check"::JSON AS j FROM rules
  WHERE status = 'approved' AND table_fqn IN ('main.silver.brand2', 'main.silver.brand3') AND "check" LIKE '%check%')
SELECT rule_id, json_extract_string(j, '$.name') AS name FROM good WHERE json_type(j) = 'OBJECT'
  AND lower(trim(json_extract_string(j, '$.user_metadata.monitor_only'))) <> 'true'
UNION ALL SELECT rule_id, json_extract_string(j, '$[0].name') FROM good WHERE json_type(j) = 'ARRAY'""")
def approved_checks(spark, sf):
    """The checks a validation of two tables would enforce, as the evaluator gets them."""
    table = X.frame(spark, sf, "RULES").filter(F.col("check").contains("check"))
    marked = table.withColumn("check", F.regexp_replace("check", '"name":"', F.concat(F.lit('"name":"'), "rule_id", F.lit("~"))))
    found = rules.approved_checks(marked, ["main.silver.brand3", " main.silver.brand2 "])
    return found.select(F.split_part("name", F.lit("~"), F.lit(1)).alias("rule_id"), F.split_part("name", F.lit("~"), F.lit(2)).alias("name"))


@query("""WITH e AS (SELECT p_brand AS dataset, p_type AS rule_name, sum(p_size) AS n FROM part GROUP BY ALL)
SELECT dataset, rule_name, row_number() OVER (PARTITION BY dataset
  ORDER BY CASE WHEN n % 5 = 0 THEN 1000000 ELSE n END, rule_name)::INTEGER AS place FROM e""")
def playbook_loaded(spark, sf):
    """Entries of every dataset in the order they are tried; no priority comes last."""
    kinds = X.table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.sum("p_size").alias("n"))
    entries = kinds.select(
        F.col("p_brand").alias("dataset"),
        F.col("p_type").alias("rule_name"),
        F.when(F.col("n") % 5 != 0, F.col("n").cast("int")).alias("priority"),
        F.lit(None).cast("string").alias("where"),
        F.lit("reject_rows").alias("strategy"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.lit(None).cast("array<string>").alias("match_fqns"),
    )
    return playbooks.ranked_entries(entries).select("dataset", "rule_name", "place")


@query(DIRTY + """SELECT order_id, status, NULL AS code FROM dirty WHERE order_id % 2 = 0
UNION ALL SELECT order_id, NULL, code FROM dirty WHERE order_id % 3 = 0""")
def append_evolved(spark, sf):
    """Later appends may add columns and lack others."""
    def work(catalog: str) -> DataFrame:
        dirty, fqn = X.frame(spark, sf, "DIRTY"), f"{catalog}.quarantine.t"
        tables.append(dirty.filter("order_id % 2 = 0").select("order_id", "status"), fqn)
        tables.append(dirty.filter("order_id % 3 = 0").select("code", "order_id"), fqn)
        return tables.read(spark, fqn).select("order_id", "status", "code")

    return _stored(spark, work)


@query(X.prelude() + f"""SELECT count(*) AS invalid_rows, count(*) FILTER (WHERE {' OR '.join(X.ERRORS)}) AS error_rows,
  count(*) FILTER (WHERE {' OR '.join(X.WARNINGS)}) AS warning_rows, count(*) AS stored_rows,
  (SELECT count(*) FROM flags WHERE NOT ({' OR '.join(X.ERRORS)})) AS valid_rows
FROM flags WHERE {' OR '.join(X.ERRORS + X.WARNINGS)}""")
def quarantine_counts(spark, sf):
    """A validation run on stored rules: what it counted, wrote and returned; a clean run writes nothing."""
    import json

    def work(catalog: str) -> DataFrame:
        source = f"{catalog}.silver.orders"
        listed = [(c["name"], source, "approved", json.dumps(c)) for c in X.CHECKS]
        table = spark.createDataFrame(listed, "rule_id string, table_fqn string, status string, `check` string")
        gate = Validator(spark, table)
        valid = gate.run_validation(X.frame(spark, sf, "DIRTY"), source, "order_id")
        n = dict(gate.last_counts)
        gate.run_validation(X.frame(spark, sf, "DIRTY").limit(0), source, "order_id")
        stored = tables.read(spark, gate.quarantine_name(source)).count()
        row = (n["invalid_rows"], n["error_rows"], n["warning_rows"], stored, valid.count())
        return spark.createDataFrame(
            [row], "invalid_rows long, error_rows long, warning_rows long, stored_rows long, valid_rows long"
        )

    return _stored(spark, work)


@query("""SELECT 'r' || c_custkey AS rule_name, 'where is not a boolean expression' AS problem FROM customer
WHERE c_custkey % 4 IN (1, 2)""")
def lint_where(spark, sf):
    """Predicates of a playbook that do not parse, or are no predicates, against the source table."""
    customer = X.table(spark, sf, "customer")
    kind = F.col("c_custkey") % 4
    where = (
        F.when(kind == 1, "status =").when(kind == 2, "amount + 1").when(kind == 3, "status = 'F'")
    )
    entries = customer.select(
        F.lit("orders").alias("dataset"),
        F.concat(F.lit("r"), "c_custkey").alias("rule_name"),
        F.col("c_custkey").cast("int").alias("priority"),
        where.alias("where"),
        F.lit("reject_rows").alias("strategy"),
        F.create_map().cast("map<string,string>").alias("params"),
        F.lit(None).cast("array<string>").alias("match_fqns"),
    )
    return playbooks.validate_playbook(entries, X.frame(spark, sf, "DIRTY")).select("rule_name", "problem")
