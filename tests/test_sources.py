"""Rules, playbook files, tables, names and row identity."""

import hashlib
import json
import pathlib

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.functions import identity
from mendflow.operators import validate as V
from mendflow.sources import playbooks, rules, tables


# --- rules ----------------------------------------------------------------------------------------

def rule(rule_id, payload, table="main.silver.orders", status="approved"):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return rule_id, table, status, text


def rule_table(spark, *listed):
    return spark.createDataFrame(list(listed), "rule_id string, table_fqn string, status string, `check` string")


def loaded(spark, *payloads):
    frame = spark.createDataFrame(
        [(f"rule-{i:02d}", "shop.gold.baskets", p) for i, p in enumerate(payloads)],
        "rule_id string, table_fqn string, check_json string",
    )
    return rules.checks_from_rows(frame)


def test_payloads_are_read_in_order_and_lists_flattened(spark):
    many = [{"name": f"n{i}", "check": {"arguments": {"at": i}}} for i in range(12)]
    found = loaded(spark, json.dumps(many[:1]), json.dumps(many[1]), json.dumps(many[2:]))
    assert found == many
    assert loaded(spark) == []


@pytest.mark.parametrize("flag, kept", [("true", 0), (" TRUE\t", 0), ("True ", 0), ("no", 1), ("", 1)])
def test_watched_rules_are_not_enforced(spark, flag, kept):
    watched = {"name": "basket_total", "user_metadata": {"monitor_only": flag, "owner": "ops"}}
    assert len(loaded(spark, json.dumps(watched))) == kept
    assert [c["name"] for c in loaded(spark, json.dumps([watched, {"name": "z"}]))][-1] == "z"


@pytest.mark.parametrize("text, what", [("\n ", "empty"), (None, "empty"), ("[1, {", "invalid"), ("true", "invalid"), ("[7]", "invalid")])
def test_bad_payloads_raise(spark, text, what):
    with pytest.raises(ValueError, match=what):
        loaded(spark, '{"name": "fine"}', text)


def test_approved_checks(spark):
    table = rule_table(
        spark,
        rule("r1", {"name": "a"}),
        rule("r2", {"name": "b"}, status="Approved"),
        rule("r3", {"name": "c"}, table="main.silver.other"),
        rule("r4", {"name": "d", "user_metadata": {"monitor_only": "true"}}),
    )
    assert [c["name"] for c in rules.approved_checks_for(table, "main.silver.orders")] == ["a"]
    with pytest.warns(UserWarning, match="nope"):
        found = rules.approved_checks_for(table, [" main.silver.orders ", "main.silver.orders", "", "nope"])
    assert len(found) == 1
    with pytest.raises(ValueError, match="No approved rules found"):
        rules.approved_checks_for(table, "nope")


@pytest.mark.parametrize("bad", ["", "   ", [], ["  ", ""], None])
def test_table_names_are_required(spark, bad):
    with pytest.raises(ValueError):
        rules.approved_checks_for(rule_table(spark, rule("r1", {})), bad)


def test_variant_and_struct_payloads(spark):
    table = rule_table(spark, rule("r1", {"name": "a", "check": {"function": "is_not_null"}}))
    as_variant = table.withColumn("check", F.parse_json("check"))
    as_struct = table.withColumn("check", F.from_json("check", "name string, `check` struct<function:string>"))
    for frame in (as_variant, as_struct):
        found = rules.approved_checks_for(frame, "main.silver.orders")
        assert found == [{"name": "a", "check": {"function": "is_not_null"}}]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_tokens_are_bound_wherever_they_stand(order):
    tokens = ["${column}", "__COLUMN__", "{{column}}"]
    text = " <> ".join(f"lag({tokens[i]}) in [{tokens[i]}]" for i in order)
    bound = rules.bind_universal({"check": {"arguments": {"expression": text, "deep": [{"x": text}]}}}, "zip code", ["zip code"])
    want = " <> ".join(["lag(zip code) in [zip code]"] * 3)
    assert bound["check"]["arguments"] == {"expression": want, "deep": [{"x": want}]}


def test_lists_stay_lists_only_where_the_token_is_alone():
    template = {"a": "__COLUMNS__", "b": "sum(${columns}) > {{columns_csv}}", "c": ["{{columns}}", 5, None, True]}
    bound = rules.bind_universal(template, "q2", ["q1", "q2", "q3"])
    assert bound == {"a": ["q1", "q2", "q3"], "b": "sum(q1,q2,q3) > q1,q2,q3", "c": [["q1", "q2", "q3"], 5, None, True]}
    assert template["a"] == "__COLUMNS__"


@pytest.mark.parametrize("name", ['say "hi"', "back\\slash", "{{columns}}", "ünï\n"])
def test_binding_twice_changes_nothing(name):
    once = rules.bind_universal({"name": "chk_{{column}}", "column": "*", "columns": []}, name, [name, "other"])
    assert once["name"] == f"chk_{name}" and once["column"] == name and once["columns"] == [name, "other"]
    if "{{" not in name:
        assert rules.bind_universal(once, "unused", ["unused"]) == once


def test_column_lists():
    assert rules.column_list("email") == ["email"]
    assert rules.column_list(["a", "b", "a", " c "]) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        rules.column_list([" ", ""])
    with pytest.raises(TypeError):
        rules.column_list(123)


# --- identity and names ---------------------------------------------------------------------------

@pytest.mark.parametrize("asked, want", [
    (" sku ", ["sku"]), (["day", "sku"], ["day", "sku"]), (("sku", "", " sku"), ["sku"]), (None, []), ([], []), ("", []),
])
def test_key_columns(asked, want):
    assert identity.key_columns(asked, ["sku", "day", "qty"]) == want


@pytest.mark.parametrize("asked, what", [("Sku", "Sku"), (["day", "x", "w"], r"\['w', 'x'\]"), ([" "], "blank"), (["", "\t"], "blank")])
def test_key_columns_must_exist(asked, what):
    with pytest.raises(ValueError, match=what):
        identity.key_columns(asked, ["sku", "day", "qty"])


def test_row_id_values(spark):
    df = spark.createDataFrame([(2, 3), (None, 3)], "a int, b int")
    got = [r["_row_id"] for r in identity.with_row_id(df, ["a", "b"]).orderBy(F.col("a").desc_nulls_last()).collect()]
    want = [hashlib.sha256(t.encode()).hexdigest() for t in ("2\x1f3", "\x00NULL\x00\x1f3")]
    assert got == want
    with pytest.warns(UserWarning):
        assert identity.with_row_id(df).head()["_row_id_keys"] == ""


def test_table_names_in_text(spark):
    def found(text, exclude=()):
        df = spark.createDataFrame([(text,)], "t string")
        return identity.extract_table_names(df, "t", exclude).head()["table_names"]

    text = "merge into `lake`.`raw`.`t1` using lake.raw.t2 on lake.raw.t1.id = 1 -- see lake.Information_Schema.columns"
    assert found(text) == ["lake.raw.t1", "lake.raw.t2"]
    assert found(text, ["LAKE.raw.t2"]) == ["lake.raw.t1"]
    assert found("a.b and c.d, x . y . z") == []
    assert found(None) == [] and found("") == []


NAMES = [
    (["shop.Gold.Baskets"], "shop.quarantine.gold_baskets"),
    ([" shop.gold.z ", "shop.gold.m", "shop.gold.z"], "shop.quarantine.gold_cross_table__m__z"),
    (["shop.raw.t", "shop.gold.t", "shop.gold.a"], "shop.quarantine.cross_table__gold_a__gold_t__raw_t"),
]


@pytest.mark.parametrize("listed, want", NAMES)
def test_quarantine_names(spark, listed, want):
    assert V.quarantine_name(listed) == want
    assert V.quarantine_name(listed[::-1]) == want
    assert V.quarantine_name(listed, "ops.bad_rows") == want.replace("shop.quarantine", "ops.bad_rows")
    assert not V.is_shortened(want)


def test_long_names_end_in_a_digest(spark):
    many = [f"shop.gold.basket_items_of_store_{i:04d}" for i in range(40)]
    name = V.quarantine_name(many).rsplit(".", 1)[1]
    assert name.startswith("gold_cross_table__") and len(name) == len("gold_cross_table__") + 8
    assert V.is_shortened(name) and name != V.quarantine_name(many[:-1]).rsplit(".", 1)[1]
    # One source is no cross-table run, however long its name.
    one, other = (V.quarantine_name("shop.gold." + "b" * 230 + end).rsplit(".", 1)[1] for end in "xy")
    assert one.startswith("gold_bbbb") and len(one) == 200 and one[:190] == other[:190] and one != other


@pytest.mark.parametrize("bad, what", [
    ("gold.baskets", "malformed"), ("shop. .baskets", "malformed"), (["shop.gold.a", "shop.gold.b.c"], "malformed"),
    (["shop.gold.a", "lab.gold.a"], "span_catalogs"), ("\t", "non-empty"), ([], "non-empty"),
])
def test_names_that_cannot_be_made(spark, bad, what):
    with pytest.raises(ValueError, match=what):
        V.quarantine_name(bad)


def test_the_override_is_a_schema(spark):
    with pytest.raises(ValueError, match="quarantine_table must be"):
        V.quarantine_name("shop.gold.a", "ops")


# --- playbook files -------------------------------------------------------------------------------

def test_playbook_yaml_and_order(tmp_path, spark):
    path = tmp_path / "silver_orders.yaml"
    path.write_text(
        "playbooks:\n"
        "  - {rule_name: b, strategy: reject_rows, params: {}}\n"
        "  - {rule_name: a, priority: 5, strategy: dedupe_keep_latest, where: \"x = 1\",\n"
        "     params: {partition_by: [k], order_by: t}}\n"
    )
    entries = playbooks.read_yaml(str(path))
    assert [e["rule_name"] for e in playbooks.by_priority(entries)] == ["a", "b"]
    assert playbooks.read_yaml(str(tmp_path / "absent.yaml")) == []
    assert playbooks.dataset_name("main.quarantine.silver_orders") == "silver_orders"
    frame = playbooks.entries_frame(spark, {"silver_orders": entries, "other": entries[:1]})
    loaded = playbooks.playbook_entries(frame, "silver_orders")
    assert [e["rule_name"] for e in loaded] == ["a", "b"]
    assert loaded[0]["params"] == {"partition_by": ["k"], "order_by": "t"} and loaded[0]["where"] == "x = 1"
    assert playbooks.playbook_entries(frame, "absent") == []


def test_playbook_validation(spark):
    source = spark.createDataFrame([], "k int, t timestamp, email string")
    good = {"rule_name": "a", "priority": 1, "where": "k > 1", "strategy": "dedupe_keep_latest",
            "params": {"partition_by": ["k"], "order_by": "t", "ci_columns": ["k"]}}
    bad = [
        {"rule_name": "b", "priority": 2, "where": "k >", "strategy": "reject_rows", "params": {}},
        {"rule_name": "c", "priority": 3, "where": "k + 1", "strategy": "reject_rows", "params": {}},
        {"rule_name": "d", "priority": 3, "strategy": "standardize_value",
         "params": {"column": "nope", "transform": "shout"}},
    ]
    frame = playbooks.entries_frame(spark, {"d": [good, *bad]})
    got = rows(playbooks.validate_playbook(frame, source), "rule_name", "problem")
    assert got == sorted([
        ("b", "where is not a boolean expression"), ("c", "where is not a boolean expression"),
        ("c", "duplicate priority"), ("d", "duplicate priority"), ("d", "unknown column"),
        ("d", "unknown transform"),
    ], key=str)


# --- tables ---------------------------------------------------------------------------------------

def test_append_evolves_the_schema(spark):
    fqn = "main.quarantine.evolving"
    tables.append(spark.createDataFrame([(1, "a")], "id int, v string"), fqn)
    tables.append(spark.createDataFrame([("b", 2, [1])], "v string, id int, extra array<int>"), fqn)
    tables.append(spark.createDataFrame([(3,)], "id int"), fqn)
    assert rows(tables.read(spark, fqn), "id", "v", "extra") == [(1, "a", None), (2, "b", [1]), (3, None, None)]


def test_replace_may_read_its_own_table(spark):
    fqn = "main.silver.swapped"
    tables.replace(spark.createDataFrame([(1,), (2,)], "id int"), fqn)
    old = tables.read(spark, fqn)
    tables.replace(old.withColumn("id", F.col("id") + 10), fqn)
    assert rows(tables.read(spark, fqn)) == [(11,), (12,)]
    tables.replace(tables.read(spark, fqn).withColumn("more", F.lit("x")), fqn)
    assert rows(tables.read(spark, fqn)) == [(11, "x"), (12, "x")]
    assert not tables.supports_merge(spark, fqn)


def test_partitioned_tables_are_replaced_whole_or_in_part(spark):
    fqn = "main.silver.by_day"
    spark.sql("CREATE SCHEMA IF NOT EXISTS main__silver")
    spark.sql("CREATE TABLE main__silver.by_day (id INT, day STRING, k INT) USING parquet PARTITIONED BY (day, k) TBLPROPERTIES ('team' = 'ops')")
    first = spark.createDataFrame([(1, "a b/c", 1), (2, "a b/c", 2), (3, None, 1)], "id int, day string, k int")
    tables.replace(first, fqn)
    assert rows(tables.read(spark, fqn), "id") == [(1,), (2,), (3,)]
    tables.replace(tables.read(spark, fqn).withColumn("id", F.col("id") + 100).filter("id <> 102"), fqn)
    got = tables.read(spark, fqn)
    assert rows(got, "id", "day", "k") == sorted([(101, "a b/c", 1), (103, None, 1)], key=str)
    touched = spark.createDataFrame([(None, 1), ("new", 5)], "day string, k int")
    tables.replace_partitions(spark.createDataFrame([(7, "new", 5)], "id int, day string, k int"), fqn, touched)
    assert rows(tables.read(spark, fqn), "id", "day", "k") == sorted([(101, "a b/c", 1), (7, "new", 5)], key=str)
    assert tables.partition_columns(spark, fqn) == ["day", "k"]
    kept = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES main__silver.by_day").collect()}
    assert kept["team"] == "ops"


def test_columns_may_change_and_properties_stay(spark):
    fqn = "main.silver.retyped"
    tables.replace(spark.createDataFrame([(1, "x")], "id int, v string"), fqn)
    spark.sql("ALTER TABLE main__silver.retyped SET TBLPROPERTIES ('team' = 'ops')")
    tables.replace(spark.createDataFrame([("1", 2.0)], "id string, w double"), fqn)
    assert tables.read(spark, fqn).dtypes == [("id", "string"), ("w", "double")]
    kept = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES main__silver.retyped").collect()}
    assert kept["team"] == "ops"


def test_old_versions_go(spark):
    import os

    fqn = "main.silver.versions"
    for i in range(5):
        tables.replace(spark.createDataFrame([(i,)], "id int"), fqn)
    folder = tables._versions_folder(spark, fqn).removeprefix("file:")
    assert len([f for f in os.listdir(folder) if f.startswith("v-")]) == 2
    assert rows(tables.read(spark, fqn)) == [(4,)]


def test_scratch_goes_at_the_end(spark):
    import os

    with tables.scratch(spark):
        cut = tables.cut_lineage(spark.range(5))
        folder = cut.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert cut.count() == 5 and os.path.exists(folder)
    assert not os.path.exists(folder)


def test_slices_are_replaced_on_their_own(spark):
    fqn = "main.gov.sliced"
    for name, n in (("a.b", 2), ("it's", 3), ("a.b", 1)):
        df = spark.range(n).withColumn("q", F.lit(name))
        tables.replace_slice(df, fqn, "q", name)
    got = tables.read(spark, fqn)
    assert rows(got, "id", "q") == sorted([(0, "a.b"), (0, "it's"), (1, "it's"), (2, "it's")], key=str)
    plan = got.filter("q = 'a.b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(q" in plan


def test_discovery_skips_staged_tables(spark):
    one = spark.createDataFrame([(1,)], "id int")
    for name in ("silver_a", "silver_b", "silver_a" + S.STAGED_SUFFIX, "bronze_c"):
        tables.replace(one, f"disc.quarantine.{name}")
    assert rows(tables.discover(spark, "disc.quarantine", "silver_")) == [
        ("disc.quarantine.silver_a",), ("disc.quarantine.silver_b",)]
    assert tables.discover(spark, "nowhere.quarantine").count() == 0


def test_path_reads_merge_schemas(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/t/p=1")
    spark.createDataFrame([(2, 3)], "a int, b int").write.parquet(f"{tmp_path}/t/p=2")
    assert set(tables.read_path(spark, f"{tmp_path}/t").columns) == {"a", "b", "p"}


def test_checkpoint_folder_comes_from_the_session(spark):
    cut = tables.cut_lineage(spark.range(3))
    assert cut.count() == 3
    assert cut.inputFiles()[0].removeprefix("file://").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- several runs at once -------------------------------------------------------------------------

def _at_once(work, n):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(work, range(n)))


def _append_part(spark, fqn, i):
    rows = spark.range(i * 100, i * 100 + 100)
    tables.append(rows.withColumn(f"c{i % 2}", F.lit(i)) if i % 4 == 3 else rows, fqn)


def test_eight_appends_to_a_new_and_to_an_existing_table(spark):
    fqn = "atonce.q.rows"
    for turn in (0, 1):  # the first eight make the table, each by itself as far as it knows
        _at_once(lambda i, t=turn: _append_part(spark, fqn, 8 * t + i), 8)
    assert sorted(r["id"] for r in tables.read(spark, fqn).collect()) == list(range(1600))
    assert tables.APPEND not in tables.read(spark, fqn).columns
    assert tables.partition_columns(spark, fqn) == []


def test_appends_to_a_plain_table_made_elsewhere(spark):
    fqn = "atonce.q.plain"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {tables.schema_name(spark, 'atonce.q')}")
    spark.range(5).write.saveAsTable(tables.table_name(spark, fqn).replace("`", ""))
    _at_once(lambda i: tables.append(spark.range(100 + i * 10, 110 + i * 10), fqn), 8)
    assert tables.read(spark, fqn).count() == 85


def test_eight_slices_of_a_new_table(spark):
    fqn = "atonce.q.slices"
    for turn in range(3):
        _at_once(lambda i, t=turn: tables.replace_slice(spark.range(i + t).withColumn("part", F.lit(f"p{i}")), fqn, "part", f"p{i}"), 8)
    counts = {r["part"]: r["count"] for r in tables.read(spark, fqn).groupBy("part").count().collect()}
    assert counts == {f"p{i}": i + 2 for i in range(8)}


def _data_folders(spark, fqn):
    root = pathlib.Path(tables._versions_folder(spark, fqn).removeprefix("file:"))
    return {str(p.parent.relative_to(root)) for p in root.rglob("*.parquet")}


def test_replaced_folders_go_but_the_last_one(spark):
    fqn = "leaks.q.slices"
    for turn in range(4):
        for part in ("a", "b"):
            tables.replace_slice(spark.range(3 + turn).withColumn("part", F.lit(part)), fqn, "part", part)
    assert len(_data_folders(spark, fqn)) == 4  # the current folder and the one before it, of two slices

    fqn = "leaks.q.parts"
    name = tables.table_name(spark, fqn)
    spark.sql(f"CREATE TABLE {name} (id BIGINT, k STRING) USING parquet PARTITIONED BY (k)")
    for turn in range(4):
        rows = spark.range(4).selectExpr(f"id + {turn} AS id", "concat('k%/', id % 2) AS k")
        tables.replace_partitions(rows, fqn, rows.select("k"))
    assert sorted(map(tuple, tables.read(spark, fqn).collect())) == [(i + 3, f"k%/{i % 2}") for i in range(4)]
    assert len(_data_folders(spark, fqn)) == 4

    fqn = "leaks.q.appends"
    for turn in range(5):
        tables.append(spark.range(2), fqn)
    tables.replace(tables.read(spark, fqn).distinct(), fqn)
    assert sorted(r["id"] for r in tables.read(spark, fqn).collect()) == [0, 1]
    assert len(_data_folders(spark, fqn)) == 2


def test_replacing_what_was_appended_may_change_columns(spark):
    fqn = "leaks.q.columns"
    tables.append(spark.range(3), fqn)
    tables.replace(tables.read(spark, fqn).selectExpr("id", "id * 2 AS twice"), fqn)
    tables.append(spark.range(1), fqn)
    assert sorted(map(tuple, tables.read(spark, fqn).select("id", "twice").fillna(-1).collect())) == [(0, -1), (0, 0), (1, 2), (2, 4)]
    tables.replace(tables.read(spark, fqn).selectExpr("cast(id AS string) AS id"), fqn)
    assert tables.read(spark, fqn).dtypes == [("id", "string")]


def test_templates_bound_by_expression_are_those_bound_one_by_one(spark):
    templates = [
        {"name": "{{column}}_set", "column": "*", "columns": [], "check": {"function": "f", "arguments": {
            "column": "${column}", "columns": "{{columns}}", "x": "a {{columns_csv}} $ __COLUMNS__ _ {", "deep": [{"column": "*"}]}}},
        {"name": "n", "column": None, "columns": None, "check": {"a": 1}},
        {"name": "column", "column": "column", "columns": "columns", "k": None},
        {"column": "keep", "columns": ["x"], "n": 5},
    ]
    names = ['a"b', "${column}", "c,d\\e", "é{{columns}}"]
    table = spark.createDataFrame([(str(i), json.dumps(t, indent=i or None)) for i, t in enumerate(templates)], "rule_fqn string, check_json string")
    listed = [(str(i), n, k) for i in range(len(templates)) for k, n in enumerate(names)]
    columns = spark.createDataFrame(listed, "rule_fqn string, column_name string, position int")
    found = rules.bind_universal_json(table, columns).collect()
    assert len(found) == len(templates) * len(names)
    for r in found:
        assert json.loads(r["check_json"]) == rules.bind_universal(templates[int(r["rule_fqn"])], r["column_name"], names)
