"""Repairs induced from shapes: each found chain really turns the failing value into a passing one."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mendflow.functions.transforms import chain, chain_sql
from mendflow.operators import curate, induce
from tests import oracle
from tests.conftest import rows
from workloads.fixtures import check


def shape(spark, text):
    return spark.range(1).select(induce.shape_of(F.lit(text)).alias("s")).head()["s"]


def test_shapes(spark):
    assert induce.read_shape(shape(spark, "A1005")) == (("U", 1), ("D", 4))
    assert induce.read_shape(shape(spark, " a-é.. 12")) == (("S", 1), ("L", 1), ("=", "-"), ("=", "é"), ("=", "."), ("=", "."), ("S", 1), ("D", 2))
    assert induce.read_shape(shape(spark, "")) == ()


@pytest.mark.parametrize(
    "bad, good, mended",
    [
        ("A1005", "00042", "01005"),
        ("00042-X", "00042", "00042"),
        ("31/12/2023", "2024-01-05", "2023-12-31"),
        ("20231231", "2024-01-05", "2023-12-31"),
        ("31-Dec-2023", "2024-01-05", "2023-12-31"),
        ("1.2.2023", "2024-01-05", "2023-02-01"),
        ("555.1234", "555-1234", "555-1234"),
        ("5551234", "555-1234", "555-1234"),
        (" +1 555-1234", "555-1234", "555-1234"),
        ("ab c", "AB-C", "AB-C"),
        ("  x7 ", "X7", "X7"),
        ("a$b", "a.b", "a.b"),
        ("7", "007", "007"),
    ],
)
def test_chains_reach_the_passing_shape(spark, bad, good, mended):
    chains = induce.chains_between([induce.read_shape(shape(spark, bad))], [induce.read_shape(shape(spark, good))])
    assert chains and all(len(c) <= induce.STEPS for c in chains)
    frame = spark.createDataFrame([(bad,)], "v string").select(*[chain(c, "v").alias(f"c{i}") for i, c in enumerate(chains)])
    results = list(frame.head())
    assert mended in results
    shapes = {shape(spark, r) for r in results if r is not None}
    assert shapes == {shape(spark, good)}


def test_what_cannot_be_mended_has_no_chain():
    assert induce.chains_between([(("D", 3),)], [(("U", 2),)]) == []
    assert induce.chains_between([], [(("U", 2),)]) == [] == induce.chains_between([(("D", 3),)], [])


def test_proposals_from_the_data(spark):
    one = check("phone", "matches_regex", column="phone", pattern="^[0-9]{3}-[0-9]{4}$")
    good = spark.createDataFrame([(f"{i:03d}-{i:04d}",) for i in range(50)] + [("bad",), (None,)], "phone string")
    bad = spark.createDataFrame([(f"{i:03d}.{i:04d}", ["phone"]) for i in range(30)] + [(None, ["phone"]), ("x", [])], "phone string, rule_violations array<string>")
    bad = curate.with_signature(bad)
    found = induce.induced_candidates(bad, good, [one])
    assert list(found) == ["phone"]
    proposals = curate.search_transforms(bad, [one], found)
    assert rows(proposals.filter("signature = 'phone'"), "decision") == [("fix",)]
    assert rows(curate.search_transforms(bad, [one]).filter("signature = 'phone'"), "decision") == [("escalate",)]
    assert induce.induced_candidates(bad, good.limit(0), [one]) == {"phone": []}
    assert induce.induced_candidates(bad.limit(0), good, [one]) == {}
    assert induce.induced_candidates(bad, good.withColumnRenamed("phone", "other"), [one]) == {}


def test_shapes_counted_by_classes_are_those_of_the_values(spark):
    values = ["A1005", "b-2 É", "DULS", "0Aa ", "\t\v\f\r\n x", "é_Z9", "", "a$b", "  ", "A1006", " 1", "日本1"]
    frame = spark.createDataFrame([("r", v) for v in values], "rule string, value string")
    want = {induce.read_shape(r["s"]) for r in frame.select(induce.shape_of(F.col("value")).alias("s")).collect()}
    found = induce._commonest(frame, "rule", 50)["r"]
    assert set(found) == want and len(found) == len(want) and found[0] == (("U", 1), ("D", 4))


def test_the_query_reads_the_orders_once(spark):
    found = entry.queries()["induced_repairs"](spark, f"{oracle.TESTDATA}/sf0.001")
    assert found.inputFiles() and not any("orders.parquet" in f for f in found.inputFiles())


def test_truncate_is_read_in_any_case_without_the_case_tables_of_the_driver(spark):
    """lower() of a literal is folded on the driver, which then loads the case tables of all of Unicode."""
    said = ["true", "TRUE", "True", "tRuE", "false", "true ", "true\n", "", "ſtrue"]
    frame = spark.createDataFrame([("abcdef",)], "v string")
    for text in said:
        fix = {"transform": "left_pad", "length": "3", "pad": "0", "truncate": text}
        sql = chain_sql([fix], "v")
        assert "lower(" not in sql
        assert frame.select(chain([fix], "v").alias("r")).head()["r"] == ("abc" if text.lower() == "true" else "abcdef")


def test_the_query_leaves_no_join_of_the_sources_to_its_result(spark):
    found = entry.queries()["induced_repairs"](spark, f"{oracle.TESTDATA}/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 7
