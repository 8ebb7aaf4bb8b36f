"""Playbook, transforms, proposals, patching and merging on small frames."""

import datetime as dt
import os
import random
import re
import subprocess
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions import transforms as T
from mendflow.operators import curate, lookup, playbook, probe, reingest
from mendflow.operators import queue as Q
from tests.conftest import rows
from workloads.fixtures import check

RESULT = S.RESULT_DDL


def result(*named):
    return [(n, f"{n} failed", "matches_regex", [c]) for n, c in named] or None


QUARANTINE_DDL = (
    f"id int, code string, amount double, seen int, _error {RESULT}, _warning {RESULT}, _row_id string, "
    "_row_id_keys string, _generated_at timestamp, _data_source string, _is_cross_table boolean"
)
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def quarantine(spark, *listed):
    made = [
        (i, code, amount, seen, result(*errors), None, f"r{i}", "id", at, "main.silver.t", False)
        for i, code, amount, seen, errors, at in listed
    ]
    return spark.createDataFrame(made, QUARANTINE_DDL)


BAD_CODE = ("bad_code", "code")
DUP = ("dup", "code")


def latest(spark, *listed):
    return Q.latest_quarantined(quarantine(spark, *listed))


def empty_queue(spark):
    return spark.createDataFrame([], S.QUEUE_DDL)


# --- triage ---------------------------------------------------------------------------------------

def test_rule_names_errors_first_and_null_safe(spark):
    df = spark.createDataFrame(
        [(result(("b", "x"), ("a", "x")), result(("a", "x"), ("c", "x"))), (None, None)],
        f"_error {RESULT}, _warning {RESULT}",
    )
    from mendflow.functions.identity import rule_violations

    got = [r[0] for r in df.select(rule_violations()).collect()]
    assert got == [["b", "a", "c"], []]


def test_triage_is_idempotent_and_requeues_on_request(spark):
    first = quarantine(spark, (1, "A", 1.0, 1, [BAD_CODE], T0), (2, "B", 1.0, 1, [BAD_CODE], T0))
    new = Q.triage(first, empty_queue(spark), "q", "run1")
    assert new.columns == S.QUEUE_COLUMNS and new.count() == 2
    assert Q.triage(first, new, "q", "run2").count() == 0
    assert Q.triage(first, new, "other", "run2").count() == 2
    ids = [r[0] for r in Q.triage(first, empty_queue(spark), "q", "run9").select("review_id").collect()]
    assert sorted(ids) == sorted(r[0] for r in new.select("review_id").collect())
    later = first.unionByName(quarantine(spark, (1, "A", 1.0, 1, [BAD_CODE], T1)))
    done = new.withColumn("status", F.lit(S.REINGESTED))
    assert Q.triage(later, done, "q", "run2").count() == 0
    again = Q.triage(later, done, "q", "run2", requeue="newer")
    assert rows(again, "row_id", "quarantine_generated_at") == [("r1", T1)]
    assert Q.triage(later, new, "q", "run2", requeue="newer").count() == 0
    with pytest.raises(ValueError):
        Q.triage(later, new, "q", "run2", requeue="always")


# --- playbook -------------------------------------------------------------------------------------

def test_first_entry_wins_and_broken_entries_are_skipped(spark):
    df = latest(
        spark, (1, "A1", 1.0, 1, [BAD_CODE], T0), (2, "9", 1.0, 1, [BAD_CODE, DUP], T0), (3, "9", 1.0, 2, [DUP], T0)
    )
    entries = playbook.usable_entries(
        [
            {"rule_name": "dup", "priority": 20, "strategy": "dedupe_keep_latest",
             "params": {"partition_by": ["code"], "order_by": "seen"}},
            {"rule_name": "bad_code", "priority": 10, "strategy": "reject_rows", "where": "code rlike '^[A-Za-z]'",
             "params": {"reason": "prefix"}},
            {"rule_name": "bad_code", "priority": 1, "strategy": "reject_rows", "params": {"reason": "REPLACE_ME"}},
            {"rule_name": "bad_code", "priority": 2, "strategy": "guess", "params": {}},
            {"rule_name": "bad_code", "priority": 3, "strategy": "reject_rows", "params": {}, "match_fqns": ["x"]},
        ],
        "main.quarantine.t",
    )
    assert [e["priority"] for e in entries] == [10, 20]
    out = playbook.apply_playbook(df, entries)
    got = rows(out, "row_id", "playbook_rule", "remediation_action")
    assert got == [("r1", "bad_code", "reject"), ("r2", "dup", "drop"), ("r3", "dup", "keep")]
    assert playbook.apply_playbook(df, []).count() == 0


@pytest.mark.parametrize("direction, kept", [("desc", "r2"), ("asc", "r1")])
def test_dedupe_order_nulls_and_ties(spark, direction, kept):
    df = spark.createDataFrame(
        [("r1", "A", 1), ("r2", "a", 5), ("r3", "A", None), ("r0", "A", None), ("r9", "z", None), ("r8", "z", None)],
        "row_id string, k string, t int",
    )
    params = {"partition_by": ["k"], "ci_columns": ["k"], "order_by": "t", "order_direction": direction}
    out = playbook.dedupe_keep_latest(df, params)
    assert rows(out.filter("remediation_action = 'keep'"), "row_id") == [(kept,), ("r8",)]
    assert out.count() == 6


def test_dedupe_of_one_hot_key_never_gathers_its_rows(spark):
    df = spark.range(0, 5000, 1, 16).select(
        F.col("id").cast("string").alias("row_id"), F.substring(F.concat(F.lit("same"), "id"), 1, 4).alias("k"), (F.col("id") % 97).alias("t")
    )
    out = playbook.dedupe_keep_latest(df, {"partition_by": ["k"], "order_by": "t"})
    assert out.filter("remediation_action = 'keep'").count() == 1 and out.count() == 5000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_strategies(spark):
    df = spark.createDataFrame([("r1", " Ab ", None), ("r2", None, 5)], "row_id string, v string, n int")
    fixed = playbook.standardize_value(df, {"column": "v", "transform": "lower_trim"})
    assert rows(fixed, "row_id", "action_payload") == [("r1", {"v": "ab"}), ("r2", {"v": None})]
    filled = playbook.fill_default(df, {"column": "n", "default_expr": "1 + 1"})
    assert rows(filled, "row_id", "action_payload") == [("r1", {"n": "2"}), ("r2", {})]
    forced = playbook.fill_default(df, {"column": "n", "default_expr": "1 + 1", "overwrite": True})
    assert rows(forced, "row_id", "action_payload") == [("r1", {"n": "2"}), ("r2", {"n": "2"})]
    assert rows(playbook.reject_rows(df, {}), "action_payload") == [({"reason": "rejected_by_playbook"},)] * 2
    with pytest.raises(ValueError, match="Unknown transform"):
        playbook.standardize_value(df, {"column": "v", "transform": "shout"})
    assert playbook.combine([fixed, filled.drop("action_payload")]).count() == 4


# --- transforms -----------------------------------------------------------------------------------

CASES = [
    ({"transform": "trim"}, " a\t ", "a\t"),
    ({"transform": "lower"}, "Ab", "ab"),
    ({"transform": "upper"}, "Ab", "AB"),
    ({"transform": "lower_trim"}, " Ab ", "ab"),
    ({"transform": "upper_trim"}, " Ab ", "AB"),
    ({"transform": "regexp_replace", "pattern": "[0-9]", "replacement": "x"}, "a1b2", "axbx"),
    ({"transform": "regexp_replace", "pattern": "[0-9]"}, "a1b2", "ab"),
    ({"transform": "regexp_extract", "pattern": "([a-z])([0-9])", "group": "2"}, "a1b2", "1"),
    ({"transform": "regexp_extract", "pattern": "q"}, "a1", ""),
    ({"transform": "to_date", "from_format": "dd/MM/yyyy"}, "31/12/2024", "2024-12-31"),
    ({"transform": "to_date", "from_format": "dd/MM/yyyy"}, "junk", None),
    ({"transform": "to_timestamp", "from_format": "dd/MM/yyyy HH:mm"}, "31/12/2024 05:06", "2024-12-31 05:06:00"),
    ({"transform": "left_pad", "length": "5"}, "12", "00012"),
    ({"transform": "left_pad", "length": "5"}, "123456", "123456"),
    ({"transform": "left_pad", "length": "5", "truncate": "true"}, "123456", "12345"),
    ({"transform": "right_pad", "length": "4", "pad": "*"}, "12", "12**"),
    ({"transform": "substring", "pos": "2"}, "hello", "ello"),
    ({"transform": "substring", "pos": "-2", "len": "1"}, "hello", "l"),
    ({"transform": "set_default", "value": "d"}, None, "d"),
    ({"transform": "set_default", "value": "d"}, "v", "v"),
    ({"transform": "set_null"}, "v", None),
]


@pytest.mark.parametrize("fix, value, want", CASES)
def test_transforms_static_and_from_a_table(spark, fix, value, want):
    df = spark.createDataFrame([(value, [fix])], "v string, fixes array<map<string,string>>")
    got = df.select(T.chain([fix], "v").alias("a"), F.expr(T.run_steps("v", "fixes")).alias("b")).head()
    assert (got["a"], got["b"]) == (want, want)


def test_bad_fixes(spark):
    bad = [{"transform": "reverse"}, {"transform": "left_pad"}, {"transform": "left_pad", "length": "x"}, {}]
    df = spark.createDataFrame([([f],) for f in [*bad, {"transform": "trim"}]], "f array<map<string,string>>")
    assert [r[0] for r in df.select(F.expr(T.is_bad_fix("f[0]"))).collect()] == [True] * 4 + [False]
    for fix in bad:
        with pytest.raises(ValueError):
            T.check_fix(fix)
    assert list(T.build_column_exprs([{"column": "zz", "transform": "trim"}], ["a"])) == []


# --- curation -------------------------------------------------------------------------------------

def curatable(spark, *listed):
    return curate.with_signature(latest(spark, *listed))


def proposals(spark, *listed):
    return spark.createDataFrame(list(listed), S.PROPOSAL_DDL)


def decide(df, proposed):
    out = curate.apply_proposals(df, proposed).collect()
    return {r["row_id"]: (r["decision"], r["proposed_fix"], r["confidence"], r["reasoning"]) for r in out}


def fix(*steps):
    return [{"column": "code", **s} for s in steps]


def test_fixes_reach_every_row_of_the_signature(spark):
    df = curatable(spark, (1, "A12", 1.0, 1, [BAD_CODE], T0), (2, "B7", 1.0, 1, [BAD_CODE], T0))
    steps = fix({"transform": "regexp_replace", "pattern": "^[A-Z]+"}, {"transform": "left_pad", "length": "5"})
    got = decide(df, proposals(spark, ("bad_code", "fix", steps, 0.9, "ok")))
    assert got == {"r1": ("fix", {"code": "00012"}, 0.9, "ok"), "r2": ("fix", {"code": "00007"}, 0.9, "ok")}


@pytest.mark.parametrize(
    "decision, steps, want",
    [
        ("fix", fix({"transform": "trim"}), ("escalate", 0.0, "proposed transform was a no-op (before == after): why")),
        ("fix", fix({"transform": "reverse"}), ("escalate", 0.0, "bad_transform: why")),
        ("fix", [{"column": "amount", "transform": "trim"}], ("escalate", 0.0, "no valid flagged column in fixes: why")),
        ("fix", [], ("escalate", 0.9, "why")),
        ("fix", None, ("escalate", 0.9, "why")),
        ("reject", [], ("reject", 0.9, "why")),
        ("escalate", [], ("escalate", 0.9, "why")),
        ("shrug", [], ("escalate", 0.9, "why")),
    ],
)
def test_decisions(spark, decision, steps, want):
    df = curatable(spark, (1, "A12", 1.0, 1, [BAD_CODE], T0))
    got = decide(df, proposals(spark, ("bad_code", decision, steps, 0.9, "why")))["r1"]
    assert (got[0], got[2], got[3]) == want and got[1] is None


def test_missing_proposal_escalates(spark):
    df = curatable(spark, (1, "A12", 1.0, 1, [BAD_CODE], T0))
    assert decide(df, proposals(spark))["r1"][:3] == ("escalate", None, 0.0)


def test_null_results_only_count_when_asked_for(spark):
    df = curatable(spark, (1, "A12", 1.0, 1, [BAD_CODE], T0))
    lost = proposals(spark, ("bad_code", "fix", fix({"transform": "to_date", "from_format": "yyyy"}), 0.9, ""))
    assert decide(df, lost)["r1"][:2] == ("fix", None)
    nulled = proposals(spark, ("bad_code", "fix", fix({"transform": "set_null"}), 0.9, ""))
    assert decide(df, nulled)["r1"][:2] == ("fix", {"code": None})


def test_statuses_and_gates(spark):
    ddl = "row_id string, decision string, proposed_fix map<string,string>, confidence double"
    df = spark.createDataFrame(
        [("a", "fix", {"c": "1"}, 0.8), ("b", "fix", {"c": "1"}, 0.79), ("c", "reject", None, 0.1), ("d", "escalate", None, 0.1)],
        ddl,
    )
    out = curate.decisions_to_updates(df, "q", "run")
    assert rows(out, "row_id", "status", "remediation_action") == [
        ("a", "curated", "patch_fields"), ("b", "escalated", "patch_fields"), ("c", "rejected", None),
        ("d", "escalated", None)]
    assert curate.gate_confidence(df).head()[0] == 0.79
    assert curate.gate_confidence(df.filter("decision <> 'fix'")).head()[0] == 1.0


def test_table_gate_also_holds_back_playbook_rows(spark):
    queue = spark.createDataFrame(
        [("q1", "a", "playbook", None, 1.0, "curated"), ("q1", "b", "agent", "fix", 0.5, "escalated"),
         ("q2", "c", "agent", "fix", 0.9, "curated")],
        "quarantine_fqn string, row_id string, remediation_source string, agent_decision string, "
        "confidence double, status string",
    )
    assert rows(curate.confidence_gate(queue), "row_id") == [("a",), ("c",)]
    assert rows(curate.confidence_gate(queue, mode="table"), "row_id") == [("c",)]
    with pytest.raises(ValueError):
        curate.confidence_gate(queue, mode="none")


def test_replies(spark):
    replies = spark.createDataFrame(
        [
            ("plain", '{"decision":"fix","fixes":[{"column":"c","transform":"left_pad","length":5}],"confidence":0.9}'),
            ("prose", 'Sure!\n```json\n{"decision": "reject", "confidence": 0.4, "reasoning": "no"}\n```'),
            ("quotes", "{'decision': 'escalate', 'confidence': 1}"),
            ("junk", "no idea {at all}"), ("none", None), ("half", '{"decision": "fi'),
        ],
        "signature string, reply string",
    )
    got = {r["signature"]: r for r in curate.parse_replies(replies).collect()}
    assert got["plain"]["fixes"] == [{"column": "c", "transform": "left_pad", "length": "5"}]
    assert (got["prose"]["decision"], got["prose"]["confidence"]) == ("reject", 0.4)
    assert got["quotes"]["decision"] == "escalate" and got["quotes"]["confidence"] == 1.0
    for name in ("junk", "none", "half"):
        assert (got[name]["decision"], got[name]["confidence"]) == ("escalate", 0.0)


def test_search_respects_the_column_type(spark):
    df = curatable(spark, (1, "A12", -1.0, 1, [("neg", "amount")], T0), (2, "A12", 2.0, 1, [BAD_CODE], T0))
    checks = [
        {"name": "neg", "check": {"function": "is_in_range", "arguments": {"column": "amount", "min": 0}}},
        {"name": "bad_code", "check": {"function": "matches_regex", "arguments": {"column": "code", "pattern": "^[0-9]{5}$"}}},
    ]
    got = {r["signature"]: r for r in curate.search_transforms(df, checks).collect()}
    assert got["neg"]["decision"] == "escalate"
    assert got["bad_code"]["decision"] == "fix" and got["bad_code"]["confidence"] == 0.95
    assert [f["transform"] for f in got["bad_code"]["fixes"]] == ["regexp_replace", "left_pad"]
    none = curate.search_transforms(df, [])
    assert rows(none, "decision") == [("escalate",)] * 2


def test_profiles_and_examples(spark):
    df = curatable(spark, *[(i, f"A{i}", 1.0, i, [BAD_CODE], T0) for i in range(20)])
    profile = curate.signature_profiles(df, sample_size=3).head()
    assert profile["n_rows"] == 20 and profile["flagged"] == ["code"] and len(profile["samples"]) == 3
    assert profile["rules"][0]["function"] == "matches_regex"
    silver = spark.createDataFrame([(c,) for c in "gfedcbaa"] + [(None,)], "code string")
    assert [r["value"] for r in curate.passing_examples(silver, ["code", "zz"]).orderBy("value").collect()] == list("abcde")


def test_probe_takes_the_first_normalisation_that_resolves(spark):
    ddl = "row_id string, signature string, k int, v string"
    df = spark.createDataFrame([(f"r{i}", "s", i, f" V{i} ") for i in range(10)] + [("x", "t", 99, "q")], ddl)
    other = spark.createDataFrame([(i, f"v{i}") for i in range(9)] + [(9, "zz")], "k int, v string")
    got = {r["signature"]: r for r in probe.cross_table_probe(df, other, "v", ["k"]).collect()}
    assert set(got) == {"s"}  # nothing joined for the other one
    assert got["s"]["fixes"] == [{"column": "v", "transform": "lower_trim"}] and got["s"]["confidence"] == 0.92
    strict = probe.cross_table_probe(df, other, "v", ["k"], threshold=0.95).head()
    assert (strict["decision"], strict["confidence"]) == ("escalate", 0.85)


# --- patch, re-validate, merge ----------------------------------------------------------------------

META_DDL = "_data_source string, _row_id_keys string, _is_cross_table boolean"
BASKETS = ("shop.gold.baskets", "sku ,day,", False)
TARGET_CASES = [
    ([BASKETS], (True, "shop.gold.baskets", ["sku", "day"], None)),
    ([BASKETS, ("", "sku ,day,", None), BASKETS], (True, "shop.gold.baskets", ["sku", "day"], None)),
    ([BASKETS, ("shop.gold.baskets", "day,sku", False)], (False, "shop.gold.baskets", ["day", "sku"], "no_business_key_for_merge")),
    ([("shop.gold.baskets", " , ", False)], (False, "shop.gold.baskets", [], "no_business_key_for_merge")),
    ([(None, None, None)], (False, None, [], "no_data_source")),
    # Reasons have an order: a cross-table row outranks two sources, which outrank a missing key.
    ([BASKETS, ("shop.gold.lines", None, None), ("shop.gold.lines", "x", True)], (False, None, ["sku", "day"], "cross_table_quarantine")),
    ([BASKETS, ("shop.gold.lines", None, None)], (False, None, ["sku", "day"], "ambiguous_data_source")),
    ([("", "sku", False), BASKETS, ("shop.gold.baskets", None, False)], (False, "shop.gold.baskets", ["sku"], "no_business_key_for_merge")),
]


@pytest.mark.parametrize("meta, want", TARGET_CASES)
def test_merge_target(spark, meta, want):
    got = reingest.reingest_target(spark.createDataFrame(meta, META_DDL)).head()
    assert (got["reingestable"], got["silver_fqn"], got["merge_keys"], got["reason"]) == want


def test_patch_casts_and_keeps_the_rest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", {"n": "7", "zz": "q"}), ("b", 2, "y", {"n": "seven"}), ("c", 3, "z", {"s": None}), ("d", 4, "w", None)],
        "row_id string, n int, s string, proposed_fix map<string,string>",
    )
    out = reingest.apply_patch(df)
    assert rows(out, "row_id", "n", "s", "_cast_failed") == [
        ("a", 7, "x", False), ("b", 2, "y", True), ("c", 3, None, False), ("d", 4, "w", False)]


@pytest.fixture(params=["broadcast", "shuffle"])
def either_way(request, monkeypatch):
    """Both ways of joining staged rows with the target."""
    if request.param == "shuffle":
        monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", -1)


def test_revalidation_against_the_target(spark, either_way):
    ddl = "row_id string, id int, k string"
    cand = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", 4, None)], ddl)
    target = spark.createDataFrame([(9, "X"), (2, "y"), (8, "q"), (7, None)], "id int, k string")
    unique = {"name": "u", "check": {"function": "is_unique", "arguments": {"columns": ["k"], "ci_columns": ["k"]}}}
    out = reingest.revalidate(cand, [unique], against=target, keys=["id"])
    # x collides with another row; y is the row being replaced
    assert rows(out, "row_id", "passed") == [("a", False), ("b", True), ("c", True), ("d", True)]
    unique["check"]["arguments"] = {"columns": ["k"], "nulls_distinct": False}
    out = reingest.revalidate(cand, [unique], against=target, keys=["id"])
    assert rows(out, "row_id", "passed") == [("a", True), ("b", True), ("c", True), ("d", False)]


def test_failed_casts_do_not_pass(spark):
    df = spark.createDataFrame([("a", 1, {"n": "x"})], "row_id string, n int, proposed_fix map<string,string>")
    assert reingest.revalidate(reingest.apply_patch(df), []).head()["passed"] is False


def test_merge(spark, either_way):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep"), (None, "n", "keep")], "id int, v string, extra string")
    staged = spark.createDataFrame([(1, "A", 5), (3, "C", 5), (None, "N", 5)], "id int, v string, other int")
    aligned, dropped = reingest.align_to_target(staged, target, ["id"])
    assert dropped == ["other"]
    once = reingest.merge_upsert(target, aligned, ["id"])
    want = [(1, "A", "keep"), (2, "b", "keep"), (3, "C", None), (None, "n", "keep")]
    assert rows(once) == sorted(want, key=str)
    assert rows(reingest.merge_upsert(once, aligned, ["id"])) == sorted(want, key=str)
    assert rows(reingest.null_key_rows(aligned, ["id"]), "v") == [("N",)]
    split = reingest.merge_split(aligned.filter("id is not null"), target, ["id"])
    assert tuple(reingest.merge_counts(split).head()) == (1, 1)
    with pytest.raises(ValueError, match="merge keys"):
        reingest.align_to_target(staged, target, ["nope"])
    keys_only = reingest.merge_upsert(target.select("id"), staged.select("id"), ["id"])
    assert rows(keys_only) == sorted([(1,), (2,), (3,), (None,)], key=str)


def test_merge_sql_without_values_only_inserts():
    assert "UPDATE" not in reingest.merge_sql("t", "s", ["id"], ["id"])
    assert "UPDATE SET t.`v` = s.`v`" in reingest.merge_sql("t", "s", ["id", "v"], ["id"])


def test_outcomes_only_move_open_rows(spark):
    statuses = ["pending", "curated", "revalidated_fail", "revalidated_pass", "reingested", "escalated", "rejected"]
    queue = spark.createDataFrame(
        [("q", s, s, 0, "run1", None) for s in statuses],
        "quarantine_fqn string, row_id string, status string, retry_count int, last_run_id string, updated_at timestamp",
    )
    outcomes = queue.select("quarantine_fqn", "row_id", F.lit("fail").alias("outcome"))
    moved = {r["row_id"]: (r["status"], r["retry_count"], r["last_run_id"]) for r in Q.advance_queue(queue, outcomes, "run2").collect()}
    for s in statuses:
        is_open = s in ("curated", "revalidated_fail", "revalidated_pass")
        assert moved[s] == (("revalidated_fail", 1, "run2") if is_open else (s, 0, "run1"))


# --- replies of any depth, names with bars --------------------------------------------------------

def _decisions(spark, *replies):
    table = spark.createDataFrame([(str(i), r) for i, r in enumerate(replies)], "signature string, reply string")
    return [(r["decision"], r["confidence"], r["reasoning"]) for r in curate.parse_replies(table).orderBy("signature").collect()]


def test_replies_of_any_depth(spark):
    deep = '{"decision": "fix", "extra": ' + '{"a": ' * 10 + "[{}]" + "}" * 10 + ', "confidence": 0.9}'
    found = _decisions(
        spark,
        deep,
        '{"result": ' + deep + "}",
        "{'decision': 'fix', 'confidence': 0.4, 'reasoning': None, 'x': {'y': {'z': {'w': {'v': True}}}}}",
        'look: {x, it\'s "{" then {"decision": "reject", "reasoning": "a } in \\"text\\" {", "confidence": 0.5} ok',
        '{"decision": "fi\n{"decision": "reject", "confidence": 0.7}',
        '{"a": 1} {"decision": "reject", "confidence": 1}, {"decision": "fix", "confidence": 0.1}',
        "{{{ nothing }",
        None,
        "x" * 50_000,
    )
    none = ("escalate", 0.0, "agent_unavailable: no decision in reply")
    assert found == [
        ("fix", 0.9, ""), ("fix", 0.9, ""), ("fix", 0.4, ""), ("reject", 0.5, 'a } in "text" {'),
        ("reject", 0.7, ""), ("reject", 1.0, ""), none, none, none,
    ]


def _objects_one_by_one(text):
    """Objects that name a decision, each found by a scan of its own from its brace."""
    tokens = list(re.finditer(r"""\\.|["'{}]|[^\\"'{}]+|.""", text, re.DOTALL))
    found = []
    for i, opening in enumerate(tokens):
        depth, quote, begin, named = 0, "", 0, False
        for token in tokens[i:] if opening.group() == "{" else ():
            t = token.group()
            if not quote and t in "{}":
                depth += 1 if t == "{" else -1
                if not depth:
                    found += [text[opening.start() : token.end()]] if named else []
                    break
            elif not quote and t in "\"'":
                quote, begin = t, token.end()
            elif t == quote:
                string = text[begin : token.start()]
                named |= depth == 1 and (string == "decision" or "\\" in string)
                quote = ""
    return found


def test_one_scan_finds_what_a_scan_for_each_brace_does(spark):
    rng = random.Random(8)
    parts = ["{", "{", "}", "}", '"', "'", "\\", '"decision"', "'decision'", "decision", " x: ", "é", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(5000)]
    want = [_objects_one_by_one(t) for t in texts]
    assert sum(map(bool, want)) > 100 and any(len(w) > 1 for w in want)
    table = spark.createDataFrame(list(enumerate(texts)), "i int, reply string")
    got = table.select("i", curate.decisions_in("reply").alias("found")).orderBy("i").collect()
    assert [r["found"] for r in got] == want


def test_many_braces_take_one_scan(spark):
    start = time.time()
    many = '{"a": [' * 4000
    found = _decisions(spark, *[f'{many} {{"decision": "reject", "confidence": 0.{i}}}' for i in range(1, 9)])
    assert found == [("reject", i / 10, "") for i in range(1, 9)]
    assert time.time() - start < 30


def test_long_texts_in_replies(spark):
    """A long reasoning, many words of prose and objects around the decision; literals count only outside strings."""
    start = time.time()
    prose = "it's {None} of {'them': True} " * 2000
    told = "None of " + "x" * 5000
    found = _decisions(spark, *[prose + f"{{'decision': 'fix', 'final': True, 'confidence': 0.5, 'reasoning': \"{told}{i}\"}}" for i in range(8)])
    assert found == [("fix", 0.5, f"{told}{i}") for i in range(8)]
    assert time.time() - start < 30


def test_tasks_need_no_copy_of_the_package_for_the_scan(tmp_path):
    (tmp_path / "scan").write_bytes(cloudpickle.dumps(curate._scan()))
    code = "import pickle, sys; import pyarrow as pa; run = pickle.load(open('scan', 'rb'));" + (
        """print(run(pa.array([b'{"decision": 1}', None])).to_pylist(), 'mendflow' in sys.modules)"""
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.stdout.strip() == """[[b'{"decision": 1}'], []] False""", done.stderr


def test_rule_names_with_bars_are_one_rule(spark):
    one = check("a|b", "matches_regex", column="code", pattern="^[0-9]{3}$")
    rows_ = spark.createDataFrame([("x001", ["a|b"]), ("y002", ["a|b"])], "code string, rule_violations array<string>")
    found = curate.search_transforms(curate.with_signature(rows_), [one]).collect()
    assert [(r["signature"], r["decision"]) for r in found] == [("a|b", "fix")]
    mixed = rows_.unionByName(spark.createDataFrame([("z003", ["a", "b"])], rows_.schema))
    assert [r["decision"] for r in curate.search_transforms(curate.with_signature(mixed), [one]).collect()] == ["escalate"]


# --- merges too large to send ---------------------------------------------------------------------

def test_large_merges_shuffle_what_may_match(spark, tmp_path):
    target = spark.range(2000).selectExpr("IF(id % 50 = 0, NULL, id) AS k", "concat('k', id % 7) AS s", "id AS v", "'old' AS w")
    target.coalesce(4).sortWithinPartitions("k").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    staged = spark.range(900, 1100).selectExpr("cast(id * 2 - 900 AS int) AS k", "concat('k', (id * 2 - 900) % 7) AS s", "-id AS v")
    staged = staged.unionByName(spark.createDataFrame([(None, "k1", -1), (5000, None, -2), (5000, "k9", -3)], "k int, s string, v long"))
    want = rows(reingest.merge_upsert(target, staged, ["k", "s"], small=True))
    assert rows(reingest.merge_upsert(target, staged, ["k", "s"], small=False)) == want
    maybe, never = lookup.split_by_keys(target, staged, ["k", "s"])
    assert maybe.count() + never.count() == 2000 and maybe.count() <= 220
    plan = maybe._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,900)" in plan and "Exchange hashpartitioning" not in plan
    few = lookup.split_by_keys(target, staged, ["k", "s"], bits=3)[0]  # a filter that is too small lets more through
    assert set(rows(maybe)) <= set(rows(few))
    nothing = lookup.split_by_keys(target, staged.limit(0), ["k", "s"])
    assert nothing[0].isEmpty() and nothing[1].count() == 2000
