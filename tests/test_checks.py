"""The check evaluator."""

import datetime as dt

import pytest
from tests.conftest import ORDERS_DDL, rows
from pyspark.sql import functions as F

from mendflow.operators import checks as C
from mendflow.operators import lookup

DAY = dt.date(2024, 1, 1)


def orders(spark):
    return spark.createDataFrame(
        [
            (1, 10, "F", "00001", 5.0, DAY),
            (2, None, "X", "A0002", -1.0, DAY),
            (3, 10, None, None, None, DAY),
            (4, 12, " ", "00004", 0.0, None),
        ],
        ORDERS_DDL,
    )


def check(name, function, level="error", **arguments):
    return {"name": name, "criticality": level, "check": {"function": function, "arguments": arguments}}


def failing(spark, one, refs=None, df=None):
    bad = C.split(orders(spark) if df is None else df, [one], refs)[1]
    return sorted(r["order_id"] for r in bad.collect())


@pytest.mark.parametrize(
    "one, want",
    [
        (check("a", "is_not_null", column="customer_id"), [2]),
        (check("a", "is_not_null_and_not_empty", column="status"), [3, 4]),
        (check("a", "is_not_empty", column="status"), [4]),
        (check("a", "matches_regex", column="code", pattern="^[0-9]{5}$"), [2]),
        (check("a", "is_in_list", column="status", allowed=["F", "O"]), [2, 4]),
        (check("a", "is_in_list", column="status", allowed=["f", "x"], case_sensitive=False), [4]),
        (check("a", "is_in_range", column="amount", min=0), [2]),
        (check("a", "is_in_range", column="amount", min=0, max=5, exclusive=True), [1, 2, 4]),
        (check("a", "sql_expression", expression="amount > 0"), [2, 4]),
        (check("a", "is_unique", columns=["customer_id"]), [1, 3]),
        (check("a", "is_unique", columns=["customer_id", "day"]), [1, 3]),
        (check("a", "has_format", column="status", format="email"), [1, 2, 4]),
    ],
)
def test_single_checks(spark, one, want):
    assert failing(spark, one) == want


def test_null_key_handling_of_uniqueness(spark):
    twice = orders(spark).union(orders(spark).filter("order_id = 2").withColumn("order_id", F.lit(9)))
    one = check("a", "is_unique", columns=["customer_id"])
    assert failing(spark, one, df=twice) == [1, 3]
    one["check"]["arguments"]["nulls_distinct"] = False
    assert failing(spark, one, df=twice) == [1, 2, 3, 9]


def test_foreign_key_and_cross_table(spark):
    ref = spark.createDataFrame([(10, "F"), (10, "F"), (11, "O")], "id bigint, status string")
    fk = check("a", "foreign_key", column="customer_id", ref_table="r", ref_column="id")
    assert failing(spark, fk, {"r": ref}) == [4]
    other = ref.withColumnRenamed("id", "customer_id")
    ct = check("a", "sql_query", compare_column="status", other_table="r", join_keys=["customer_id"])
    assert failing(spark, ct, {"r": other}) == [3]
    with pytest.raises(ValueError, match="refs"):
        failing(spark, fk)


def test_levels_and_result_shape(spark):
    two = [check("e", "is_not_null", column="customer_id"), check("w", "is_in_range", "warn", column="amount", min=0)]
    out = C.evaluate(orders(spark), two)
    by_id = {r["order_id"]: r for r in out.collect()}
    assert by_id[1]["_error"] is None and by_id[1]["_warning"] is None
    assert [x["name"] for x in by_id[2]["_error"]] == ["e"]
    assert by_id[2]["_error"][0]["columns"] == ["customer_id"]
    assert by_id[2]["_error"][0]["message"] == "is_not_null failed for customer_id"
    assert [x["name"] for x in by_id[2]["_warning"]] == ["w"]


def test_warn_only_rows_stay_valid_and_are_quarantined(spark):
    valid, invalid = C.split(orders(spark), [check("w", "is_in_range", "warn", column="amount", min=0)])
    assert valid.count() == 4 and invalid.count() == 1


def test_warning_checks_on_keys_do_not_shuffle_valid_rows(spark):
    checks = [check("w", "is_unique", "warn", columns=["customer_id"]), check("e", "is_not_null", column="customer_id")]
    valid, invalid = C.split(orders(spark), checks)
    assert rows(valid, "order_id") == [(1,), (3,), (4,)] and rows(invalid, "order_id") == [(1,), (2,), (3,)]
    assert "Exchange" not in valid._jdf.queryExecution().executedPlan().toString()


def test_valid_and_error_rows_make_up_the_input(spark):
    checks = [check("e", "is_not_null", column="customer_id"), check("u", "is_unique", columns=["customer_id"])]
    valid, invalid = C.split(orders(spark), checks)
    assert sorted(rows(valid, "order_id") + rows(invalid, "order_id")) == [(1,), (2,), (3,), (4,)]


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError, match="reserved"):
        C.evaluate(orders(spark).withColumn("_x", F.lit(1)), [])
    with pytest.raises(ValueError, match="unique"):
        C.evaluate(orders(spark), [check("a", "is_not_null", column="code")] * 2)
    with pytest.raises(ValueError, match="unknown check function"):
        C.evaluate(orders(spark), [check("a", "nope", column="code")])


def test_check_parsing():
    assert C.parse_check({"check": {"function": "is_not_null", "arguments": {"column": "c"}}}).name == "c_is_not_null"
    assert C.parse_check({"function": "is_not_null", "column": "c"}).columns == ["c"]
    assert len(C.parse_checks([[{"function": "a"}, {"function": "b"}], {"function": "c"}])) == 3
    with pytest.raises(ValueError):
        C.parse_check({"name": "x"})
    with pytest.raises(ValueError):
        C.parse_check({"function": "a", "criticality": "fatal"})


# --- skew -----------------------------------------------------------------------------------------

@pytest.fixture
def skewed(spark, monkeypatch):
    """A third of the rows share one key, another third has no key; every key counts as hot."""
    monkeypatch.setattr(lookup, "TASK_ROWS", 100)
    n = 3000
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") + 100)
    return spark.range(0, n, 1, 12).select(F.col("id").alias("order_id"), key.alias("k"))


def test_skewed_keys_give_exact_results(spark, skewed):
    one = check("u", "is_unique", columns=["k"])
    assert C.split(skewed, [one])[1].count() == 1000
    ref = spark.createDataFrame([(7,), (101,)], "k bigint")
    fk = check("f", "foreign_key", column="k", ref_table="r", ref_column="k")
    assert C.split(skewed, [fk], {"r": ref})[1].count() == 999
    values = spark.createDataFrame([(7, "a"), (101, "b")], "k bigint, v string")
    joined = lookup.lookup_join(skewed, values, ["k"])
    assert joined.count() == 3000
    assert dict(joined.groupBy("v").count().collect()) == {"a": 1000, "b": 1, None: 1999}


def test_hot_keys_are_found_and_spread(spark, skewed):
    hot = [tuple(r) for r in lookup.hot_keys(skewed, ["k"]).collect()]
    want = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).head()[0]
    assert hot == [(want, 10)]
    values = spark.createDataFrame([(7, "a")], "k bigint, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup.lookup_join(skewed, values, ["k"]).withColumn("p", F.spark_partition_id())
        most = joined.filter("k = 7").groupBy("p").count().agg(F.max("count")).head()[0]
        nulls = joined.filter("k is null").groupBy("p").count().agg(F.max("count")).head()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert most < 700 and nulls < 700


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_key_search_handles_empty_input(spark, skewed, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        assert lookup.hot_keys(skewed.filter("order_id < 0"), ["k"]) is None
        assert lookup.hot_keys(skewed.filter("k is null"), ["k"]) is None
        assert lookup.hot_keys(skewed.filter("order_id = 0"), ["k"]) is None
        assert lookup.hot_keys(skewed.repartition(40), ["k"]).count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_thousands_of_hot_keys_are_spread_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(lookup, "TASK_ROWS", 20)
    # 2000 keys of 40 rows and one of 400.
    df = spark.range(0, 80_400, 1, 8).select(
        F.when(F.col("id") < 80_000, F.col("id") % 2000).otherwise(5000).alias("k"), F.col("id").alias("v")
    )
    hot = lookup.hot_keys(df, ["k"])
    salts = {r["__salts"]: r["n"] for r in hot.groupBy("__salts").agg(F.count("*").alias("n")).collect()}
    assert salts == {2: 2000, 20: 1}
    values = spark.range(0, 6000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = lookup.lookup_join(df, values, ["k"])
    assert joined.count() == 80_400 and joined.filter("w <> 2 * k or w is null").count() == 0
    counts = df.groupBy("k").agg(F.count("*").alias("__n"))
    marked = lookup.counted_join(df, values, counts, ["k"])
    assert marked.count() == 80_400 and marked.filter("w <> 2 * k or w is null").count() == 0


# --- columns of value checks ----------------------------------------------------------------------

def failed(spark, rows, schema, **arguments):
    one = check("c", arguments.pop("function"), **arguments)
    return sorted(r["id"] for r in C.split(spark.createDataFrame(rows, schema), [one])[1].collect())


def test_value_checks_test_column_or_every_one_of_columns(spark):
    rows, schema = [(1, "x", None), (2, None, "y"), (3, "x", "y")], "id int, a string, b string"
    assert failed(spark, rows, schema, function="is_not_null", column="b") == [1]
    assert failed(spark, rows, schema, function="is_not_null", columns=["a", "b"]) == [1, 2]
    assert failed(spark, rows, schema, function="is_not_null", columns="a, b") == [1, 2]
    # A bound universal template names the column and all columns.
    assert failed(spark, rows, schema, function="is_not_null", column="a", columns=["a", "b"]) == [2]


def test_nested_and_expression_columns(spark):
    rows, schema = [(1, (None,), "x"), (2, ("v",), " y ")], "id int, s struct<f:string>, t string"
    assert failed(spark, rows, schema, function="is_not_null", column="s.f") == [1]
    assert failed(spark, rows, schema, function="is_in_list", column="trim(t)", allowed=["y"]) == [1]


def test_lists_with_nulls_and_without_values(spark):
    rows, schema = [(1, "x"), (2, "z"), (3, None)], "id int, a string"
    assert failed(spark, rows, schema, function="is_in_list", column="a", allowed=["x", None]) == [2]
    assert failed(spark, rows, schema, function="is_in_list", column="a", allowed=[]) == [1, 2]
    assert failed(spark, rows, schema, function="is_in_list", column="a", allowed=[None]) == [1, 2]


def test_class_join_keeps_rows(spark, skewed):
    classes = spark.createDataFrame([(7, "hot")], "k bigint, name string")
    joined = lookup.class_join(skewed, classes, ["k"])
    assert joined.count() == 3000 and joined.filter("name = 'hot'").count() == 1000


def test_latest_per_row_breaks_ties_by_content(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", None, "q")], "_row_id string, _generated_at int, v string"
    )
    first = rows(lookup.latest_per_row(df))
    again = rows(lookup.latest_per_row(df.repartition(5, "v")))
    assert first == again and len(first) == 2


def test_top_one_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("_row_id"), F.col("id").alias("_generated_at"))
    plan = lookup.latest_per_row(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_row_checks_read_only_their_columns(spark):
    from workloads import fixtures as X

    table = X.table(spark, "/root/testdata/sf0.001", "customer")
    bad = C.split(table, [check("a", "is_in_range", column="c_acctbal", min=0)])[1].select("c_custkey")
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    assert "Exchange" not in plan
