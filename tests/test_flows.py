"""Whole flows on stored tables: validation, remediation passes, dry runs and streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.operators import checks as C
from mendflow.operators import queue as Q
from mendflow.operators import validate as V
from mendflow.plans import dryrun, remediation
from mendflow.plans.validation import Validator
from mendflow.sources import tables
from mendflow.streaming import validate_stream as VS
from tests import oracle
from tests.conftest import rows
from workloads import stored_queries

DDL = "id int, customer int, code string, status string, seen int"
CODE = {"name": "code_format", "check": {"function": "matches_regex", "arguments": {"column": "code", "pattern": "^[0-9]{5}$"}}}
STATUS = {"name": "status_known", "check": {"function": "is_in_list", "arguments": {"column": "status", "allowed": ["Open", "Closed"]}}}
UNIQUE = {"name": "one_per_customer", "check": {"function": "is_unique", "arguments": {"columns": ["customer"]}}}
ENTRIES = [
    {"rule_name": "status_known", "priority": 10, "where": "status = 'Invalid'", "strategy": "reject_rows", "params": {}},
    {"rule_name": "one_per_customer", "priority": 20, "strategy": "dedupe_keep_latest",
     "params": {"partition_by": ["customer"], "order_by": "seen"}},
]
INPUT = [
    (1, 10, "00001", "Open", 1),
    (2, 20, "A2", "Open", 1),        # fixed by the transform search
    (3, 30, "00003", "Invalid", 1),  # rejected
    (4, 40, "00004", "Open", 1),     # duplicate, loses
    (5, 40, "00005", "Open", 2),     # duplicate, wins
    (6, 60, "xx-yy", "Open", 1),     # beyond repair
    (7, 70, "00007", "Opne", 1),     # no fix known
]


def rules_frame(spark, *checks, table="shop.silver.orders"):
    listed = [(f"r{i}", table, "approved", json.dumps(c)) for i, c in enumerate(checks)]
    return spark.createDataFrame(listed, "rule_id string, table_fqn string, status string, `check` string")


def setup_shop(spark, name, silver=((1, 10, "00009", "Closed", 0), (9, 90, "00009", "Open", 0))):
    """A clean table, its rules and one validated load, under its own catalog name."""
    source = f"{name}.silver.orders"
    schema = DDL + ", agent_curated boolean, confidence double, channel string"
    tables.replace(spark.createDataFrame([(*r, None, None, "store") for r in silver], schema), source)
    gate = Validator(spark, rules_frame(spark, CODE, STATUS, UNIQUE, table=source))
    valid = gate.run_validation(spark.createDataFrame(INPUT, DDL), source, ["id"])
    return source, f"{name}.quarantine.silver_orders", f"{name}.gov.queue", gate, valid


def run(spark, shop, run_id, **options):
    source, fqn, queue, gate, _ = shop
    return remediation.remediate_table(
        spark, fqn, queue, run_id, ENTRIES, gate.approved_checks_for,
        audit_fqn=queue + "_audit", metrics_fqn=queue + "_metrics", **options,
    )


def statuses(spark, shop):
    return {r["row_id"]: r["status"] for r in tables.read(spark, shop[2]).collect()}


def by_id(spark, shop):
    """Queue status by source id."""
    ids = tables.read(spark, shop[1]).select(F.col("_row_id").alias("row_id"), "id").distinct()
    joined = tables.read(spark, shop[2]).join(ids, "row_id")
    return {r["id"]: (r["status"], r["retry_count"]) for r in joined.collect()}


# --- validation -----------------------------------------------------------------------------------

def test_validation_writes_and_counts(spark):
    source, fqn, _, gate, valid = setup_shop(spark, "val")
    assert rows(valid, "id") == [(1,)]
    stored = tables.read(spark, fqn)
    assert stored.columns == [
        "id", "customer", "code", "status", "seen", "_error", "_warning", "_row_id", "_row_id_keys",
        "_generated_at", "_data_source", "_rule_sources", "_is_cross_table"]
    assert rows(stored, "id") == [(i,) for i in range(2, 8)]
    assert gate.last_counts == {"invalid_rows": 6, "error_rows": 6, "warning_rows": 0}
    assert rows(stored, "_row_id_keys", "_data_source", "_is_cross_table")[0] == ("id", source, False)
    more = spark.createDataFrame([(8, 80, "bad", "Open", 1, "x")], DDL + ", extra string")
    gate.run_validation(more, source, "id")
    assert tables.read(spark, fqn).filter("extra = 'x'").count() == 1
    gate.run_validation(spark.createDataFrame([(8, 80, "00001", "Open", 1)], DDL), source, "id")
    assert gate.last_counts["invalid_rows"] == 0 and tables.read(spark, fqn).count() == 7


def test_nothing_is_written_when_all_rows_pass(spark):
    gate = Validator(spark, rules_frame(spark, CODE, table="clean.silver.orders"))
    valid = gate.run_validation(spark.createDataFrame(INPUT[:1], DDL), "clean.silver.orders", "id")
    assert valid.count() == 1 and gate.last_counts["invalid_rows"] == 0
    assert not tables.exists(spark, "clean.quarantine.silver_orders")


def test_validation_guards(spark):
    gate = Validator(spark, rules_frame(spark, CODE))
    df = spark.createDataFrame(INPUT, DDL)
    with pytest.raises(TypeError):
        gate.run_validation("not a frame", "shop.silver.orders")
    with pytest.raises(ValueError):
        gate.run_validation(df, [])
    with pytest.raises(ValueError, match="No approved rules"):
        gate.run_validation(df, "shop.silver.unknown")
    with pytest.raises(ValueError, match="unknown columns"):
        gate.run_validation(df, "shop.silver.orders", ["nope"])
    assert not tables.exists(spark, "shop.quarantine.silver_orders")


def test_cross_table_validation(spark):
    rules = rules_frame(spark, CODE, table="cross.silver.a").unionAll(rules_frame(spark, STATUS, table="cross.silver.b"))
    gate = Validator(spark, rules)
    gate.run_validation(spark.createDataFrame(INPUT, DDL), ["cross.silver.b", "cross.silver.a"])
    stored = tables.read(spark, "cross.quarantine.silver_cross_table__a__b")
    assert rows(stored, "_data_source", "_is_cross_table", "_row_id_keys")[0] == ("cross.silver.b,cross.silver.a", True, "")


def test_universal_rules(spark):
    template = {"name": "{{column}}_set", "check": {"function": "is_not_null", "arguments": {"column": "${column}"}}}
    universal = spark.createDataFrame(
        [("u1", "Not_Null", 1, "approved", json.dumps({"name": "old"})), ("u2", "not_null", 2, "APPROVED", json.dumps(template)),
         ("u3", "not_null", 3, "draft", "{}")],
        "rule_id string, rule_fqn string, version int, status string, `check` string",
    )
    gate = Validator(spark, rules_frame(spark, CODE), universal)
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None), (3, 5, "b")], "id int, n int, s string")
    valid = gate.run_universal_rule_validation(df, " NOT_NULL ", ["n", "s"], "uni.silver.t", "id")
    assert rows(valid, "id") == [(3,)]
    stored = tables.read(spark, "uni.quarantine.silver_t")
    assert rows(stored, "id", "_rule_name", "_rule_columns", "_is_cross_table") == [
        (1, "NOT_NULL", "n,s", False), (2, "NOT_NULL", "n,s", False)]
    with pytest.raises(ValueError, match="No approved universal rule"):
        gate.run_universal_rule_validation(df, "absent", "n", "uni.silver.t")
    with pytest.raises(ValueError, match="not found in input_df"):
        gate.run_universal_rule_validation(df, "not_null", "zz", "uni.silver.t")
    with pytest.raises(ValueError, match="source_table"):
        gate.run_universal_rule_validation(df, "not_null", "n", "only.two")


# --- remediation ----------------------------------------------------------------------------------

WANT = {
    2: ("reingested", 0), 3: ("rejected", 0), 4: ("resolved_duplicate", 0), 5: ("reingested", 0),
    6: ("escalated", 0), 7: ("escalated", 0),
}


def test_a_pass_moves_rows_to_the_clean_table(spark):
    shop = setup_shop(spark, "pass")
    run(spark, shop, "run1")
    # 6 shares the signature of 2, whose fix does not reach the share the search asks for
    states = by_id(spark, shop)
    assert {k: states[k] for k in (3, 4, 5, 7)} == {k: WANT[k] for k in (3, 4, 5, 7)}
    silver = tables.read(spark, shop[0])
    got = {r["id"]: r for r in silver.collect()}
    assert got[5]["customer"] == 40 and got[5]["agent_curated"] is False and got[5]["confidence"] == 1.0
    assert got[9]["channel"] == "store" and got[5]["channel"] is None and 4 not in got
    audit = tables.read(spark, shop[2] + "_audit").head()
    assert (audit["triaged_count"], audit["playbook_resolved_count"], audit["reingested_count"]) == (6, 3, 1)
    assert audit["escalated_count"] == 3 and abs(audit["reingest_rate"] - 1 / 6) < 1e-9
    metric = tables.read(spark, shop[2] + "_metrics").head()
    assert (metric["input_row_count"], metric["passed_row_count"], metric["failed_row_count"], metric["error_row_count"]) == (6, 1, 3, 4)
    before = rows(silver)
    run(spark, shop, "run2")
    assert rows(tables.read(spark, shop[0])) == before and by_id(spark, shop) == states
    run(spark, shop, "run3", reset_queue=True)
    assert by_id(spark, shop).keys() == states.keys()
    assert {r["run_id"] for r in tables.read(spark, shop[2]).collect()} == {"run3"}


def given(*listed):
    def propose(df):
        return df.sparkSession.createDataFrame(list(listed), S.PROPOSAL_DDL)

    return propose


FIX_CODE = ("code_format", "fix", [
    {"column": "code", "transform": "regexp_replace", "pattern": "^[A-Za-z]+"},
    {"column": "code", "transform": "left_pad", "length": "5"},
], 0.9, "strip and pad")


def test_proposals_are_revalidated_retried_and_escalated(spark):
    shop = setup_shop(spark, "retry")
    proposed = given(FIX_CODE)
    run(spark, shop, "run1", propose=proposed, max_retries=2)
    states = by_id(spark, shop)
    assert states[2] == ("reingested", 0) and states[6] == ("revalidated_fail", 1)
    clean = {r["id"]: r for r in tables.read(spark, shop[0]).collect()}
    assert clean[2]["code"] == "00002" and clean[2]["agent_curated"] is True
    run(spark, shop, "run2", propose=proposed, max_retries=2)
    assert by_id(spark, shop)[6] == ("escalated", 2)
    audit = {r["run_id"]: r for r in tables.read(spark, shop[2] + "_audit").collect()}
    assert audit["run2"]["escalated_count"] == 1 and audit["run2"]["reingest_rate"] is None


def test_dry_run_leaves_rows_for_the_next_run(spark):
    shop = setup_shop(spark, "dry")
    before = rows(tables.read(spark, shop[0]))
    done = run(spark, shop, "run1", propose=given(FIX_CODE), dry_run=True)
    assert rows(tables.read(spark, shop[0])) == before
    assert by_id(spark, shop)[2] == ("revalidated_pass", 0)
    assert done["inserted"] + done["updated"] == 2
    run(spark, shop, "run2", propose=given(FIX_CODE))
    assert by_id(spark, shop)[2] == ("reingested", 0)
    assert 2 in {r["id"] for r in tables.read(spark, shop[0]).collect()}


def test_table_gate_waits_for_weak_fixes(spark):
    shop = setup_shop(spark, "gated")
    weak = ("code_format", "fix", FIX_CODE[2], 0.5, "")
    run(spark, shop, "run1", propose=given(weak), gate="table")
    states = by_id(spark, shop)
    assert states[2] == ("escalated", 0) and states[5] == ("curated", 0)
    other = setup_shop(spark, "ungated")
    run(spark, other, "run1", propose=given(weak))
    assert by_id(spark, other)[5] == ("reingested", 0)


def test_collisions_with_the_clean_table_do_not_pass(spark):
    shop = setup_shop(spark, "collide", silver=((50, 40, "00050", "Open", 0),))
    run(spark, shop, "run1", propose=given(FIX_CODE))
    assert by_id(spark, shop)[5] == ("revalidated_fail", 1)


def test_unmergeable_tables_escalate(spark):
    source = "nokey.silver.orders"
    gate = Validator(spark, rules_frame(spark, STATUS, CODE, table=source))
    gate.run_validation(spark.createDataFrame(INPUT, DDL), source)
    shop = (source, "nokey.quarantine.silver_orders", "nokey.gov.queue", gate, None)
    run(spark, shop, "run1", propose=given(FIX_CODE))
    states = by_id(spark, shop)
    assert states[2] == ("escalated", 0) and states[3] == ("rejected", 0)


def test_every_table_of_a_schema_is_processed(spark):
    for name in ("silver_a", "silver_b", "silver_a" + S.STAGED_SUFFIX):
        tables.replace(spark.range(1), f"many.quarantine.{name}")

    def one(name):
        if name.endswith("_a"):
            raise ValueError("broken")
        return name.upper()

    done = remediation.process_all(spark, "many.quarantine", one, "silver_")
    assert [(o.fqn, o.result, o.error) for o in done] == [
        ("many.quarantine.silver_a", None, "ValueError: broken"),
        ("many.quarantine.silver_b", "MANY.QUARANTINE.SILVER_B", None),
    ]


def test_fixes_that_meet_on_one_key_escalate(spark):
    source = "meet.silver.codes"
    ddl = "code string, status string"
    tables.replace(spark.createDataFrame([("a", "Open"), ("b", "Open")], ddl), source)
    lower = {"name": "lower_code", "check": {"function": "matches_regex", "arguments": {"column": "code", "pattern": "^[a-z]$"}}}
    gate = Validator(spark, rules_frame(spark, lower, table=source))
    gate.run_validation(spark.createDataFrame([("A", "Closed"), ("a ", "Closed"), ("B", "Closed")], ddl), source, "code")
    entries = [{"rule_name": "lower_code", "priority": 1, "strategy": "standardize_value", "params": {"column": "code", "transform": "lower_trim"}}]
    fqn, queue = "meet.quarantine.silver_codes", "meet.gov.queue"
    dry = dryrun.dry_run_table(spark, fqn, queue, "dry", entries, gate.approved_checks_for)
    done = remediation.remediate_table(spark, fqn, queue, "run1", entries, gate.approved_checks_for)
    assert rows(tables.read(spark, source), "code", "status") == [("a", "Open"), ("b", "Closed")]
    assert sorted(r["status"] for r in tables.read(spark, queue).collect()) == ["escalated", "escalated", "reingested"]
    assert (dry["est_reingest_insert"], dry["est_reingest_update"]) == (done["inserted"], done["updated"]) == (0, 1)


def test_partitioned_clean_tables_take_merges(spark):
    source = "parted.silver.orders"
    spark.sql("CREATE SCHEMA IF NOT EXISTS parted__silver")
    spark.sql("CREATE TABLE parted__silver.orders (id INT, code STRING, status STRING) USING parquet PARTITIONED BY (status)")
    clean = [(1, "00001", "Open"), (2, "00002", "Open"), (9, "00009", "Closed")]
    tables.replace(spark.createDataFrame(clean, "id int, code string, status string"), source)
    gate = Validator(spark, rules_frame(spark, CODE, table=source))
    gate.run_validation(spark.createDataFrame([(2, "A2", "Held"), (3, "A3", "Open")], "id int, code string, status string"), source, "id")
    args = (spark, "parted.quarantine.silver_orders", "parted.gov.queue")
    remediation.remediate_table(*args, "run1", [], gate.approved_checks_for)
    want = [(1, "00001", "Open"), (2, "00002", "Held"), (3, "00003", "Open"), (9, "00009", "Closed")]
    assert rows(tables.read(spark, source), "id", "code", "status") == want


def test_probes_and_reference_tables(spark):
    source, other = "probed.silver.orders", "probed.silver.master"
    ddl = "id int, name string"
    tables.replace(spark.createDataFrame([(i, f"NAME{i}") for i in range(40)], ddl), other)
    tables.replace(spark.createDataFrame([], ddl), source)
    same = {"name": "same_name", "check": {"function": "sql_query", "arguments": {"compare_column": "name", "other_table": other, "join_keys": ["id"]}}}
    gate = Validator(spark, rules_frame(spark, same, table=source))
    gate.run_validation(spark.createDataFrame([(i, f" name{i} ") for i in range(30)], ddl), source, "id")
    args = (spark, "probed.quarantine.silver_orders", "probed.gov.queue", "run1", [], gate.approved_checks_for)
    probes = {"same_name": remediation.Probe("name", other, ["id"])}
    # The probe says how the names agree, but not in which form; the fix must pass the rule again.
    remediation.remediate_table(*args, probes=probes)
    states = {r["status"] for r in tables.read(spark, "probed.gov.queue").collect()}
    assert states <= {"reingested", "revalidated_fail"}


def test_dry_run_report_equals_the_real_run(spark):
    shop = setup_shop(spark, "report")
    source, fqn, _, gate, _ = shop
    report = dryrun.dry_run_report(
        tables.read(spark, fqn), None, tables.read(spark, source), ENTRIES, gate.approved_checks_for(source), fqn, ["id"],
    ).head()
    assert (report["quarantined_rows"], report["already_resolved"], report["pending_rows"]) == (6, 0, 6)
    assert (report["playbook_keep_or_patch"], report["playbook_would_drop"], report["playbook_would_reject"]) == (1, 1, 1)
    assert (report["playbook_would_pass"], report["playbook_would_fail"], report["agent_eligible"]) == (1, 0, 3)
    assert (report["est_reingest_insert"], report["est_reingest_update"], report["not_reingestable"]) == (1, 0, 0)
    assert report["silver_fqn"] == source
    done = run(spark, shop, "run1", propose=given())
    assert (done["inserted"], done["updated"]) == (1, 0)
    after = dryrun.dry_run_report(
        tables.read(spark, fqn), tables.read(spark, shop[2]), tables.read(spark, source), ENTRIES,
        gate.approved_checks_for(source), fqn, ["id"],
    ).head()
    # The other three have escalated: they wait for a person, not for a run.
    assert after["already_resolved"] == 3 and after["pending_rows"] == 0 and after["playbook_keep_or_patch"] == 0
    stored = dryrun.dry_run_table(spark, fqn, shop[2], "dry", ENTRIES, gate.approved_checks_for, "report.gov.dry_runs")
    assert stored["pending_rows"] == 0 and tables.read(spark, "report.gov.dry_runs").count() == 1


def test_dry_run_report_of_an_unmergeable_table(spark):
    df = spark.createDataFrame(INPUT, DDL)
    bad = V.validate(df, [STATUS, CODE], "a.b.c", None)[1]
    report = dryrun.dry_run_report(bad, None, df.limit(0), ENTRIES, [STATUS], "q", ["id"]).head()
    assert report["not_reingestable"] == report["pending_rows"] == 4
    assert report["agent_eligible"] == report["playbook_keep_or_patch"] == 0


def test_statuses_follow_the_allowed_moves(spark):
    allowed = {
        ("pending", s) for s in ("curated", "resolved_duplicate", "rejected", "escalated")
    } | {
        ("curated", s) for s in ("resolved_removed", "escalated", "revalidated_pass", "revalidated_fail", "reingested")
    } | {
        ("revalidated_fail", s) for s in ("revalidated_fail", "escalated", "reingested", "revalidated_pass")
    } | {("revalidated_pass", "reingested"), ("pending", "reingested"), ("pending", "revalidated_fail")}
    shop = setup_shop(spark, "moves")
    old = Q.triage(tables.read(spark, shop[1]), spark.createDataFrame([], S.QUEUE_DDL), shop[1], "run0")
    tables.replace_slice(old, shop[2], "quarantine_fqn", shop[1])
    for i in range(3):
        before = tables.read(spark, shop[2])
        run(spark, shop, f"run{i}", propose=given(FIX_CODE), max_retries=2)
        changes = Q.queue_changes(before, tables.read(spark, shop[2]))
        assert {(r["old_status"], r["new_status"]) for r in changes.collect()} <= allowed


# --- streaming ------------------------------------------------------------------------------------

def test_stream_matches_batch_and_survives_a_restart(spark, tmp_path):
    df = spark.createDataFrame(INPUT, DDL)
    source = f"{tmp_path}/in"
    df.filter("id < 4").write.mode("append").parquet(source)
    sink = VS.partitioned_sink(f"{tmp_path}/valid", f"{tmp_path}/bad")
    stamp = F.lit(dt.datetime(2024, 1, 1))

    def once():
        stream = spark.readStream.schema(DDL).parquet(source)
        VS.validate_stream(
            stream, [CODE, STATUS, UNIQUE], "a.b.c", sink, f"{tmp_path}/ckpt", "id", as_of=stamp
        ).awaitTermination()

    once()
    df.filter("id >= 4").write.mode("append").parquet(source)
    once()
    once()
    bad = tables.read_path(spark, f"{tmp_path}/bad")
    assert rows(bad, "id") == [(i,) for i in range(2, 8)]
    assert rows(tables.read_path(spark, f"{tmp_path}/valid"), "id") == [(1,)]
    assert rows(bad, "batch_id") == [(0,)] * 2 + [(1,)] * 4


def test_row_checks_run_as_a_plain_stream(spark, tmp_path):
    spark.createDataFrame(INPUT, DDL).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(DDL).parquet(f"{tmp_path}/in")
    out = VS.validate_rows_stream(stream, [CODE, STATUS])
    query = out.writeStream.format("memory").queryName("checked").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = C.evaluate(spark.createDataFrame(INPUT, DDL), [CODE, STATUS])
    assert rows(spark.table("checked")) == rows(batch)
    with pytest.raises(ValueError, match="whole batches"):
        VS.validate_rows_stream(stream, [UNIQUE])


def test_failing_rows_of_eight_tables_are_found_in_one_scan(spark, monkeypatch):
    read, check_rows = [], stored_queries.V.validate
    monkeypatch.setattr(stored_queries.V, "validate", lambda rows_, *a, **k: read.append(rows_.inputFiles()) or check_rows(rows_, *a, **k))
    done = stored_queries.process_all_shared(spark, f"{oracle.TESTDATA}/sf0.001")
    assert len(read) == 8 and not any("orders.parquet" in f for files in read for f in files)
    assert done.count() == 8 and done.filter("queued = reingested AND queued = audited").count() == 8
