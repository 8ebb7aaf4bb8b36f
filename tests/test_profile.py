"""Profiles add up: merged parts tell what one profile of all rows tells."""

from pyspark.sql import functions as F

from mendflow.operators import profile as P
from tests.conftest import rows

COLUMNS = ["code", "amount"]


def told(frame):
    flat = P.read_profile(frame, shapes=3).withColumns(
        {"shapes": F.to_json("shapes"), "quantiles": F.array_join(F.transform("quantiles", lambda q: q.cast("string")), ",")}
    )
    return rows(flat)


def frame(spark):
    listed = [(f"s{i % 3}", f"A{i % 7}" if i % 5 else f"{i}-x", float(i) if i % 4 else None) for i in range(300)]
    return spark.createDataFrame([*listed, ("alone", None, None), (None, "b", 1.0)], "signature string, code string, amount double").repartition(4)


def test_parts_add_up(spark):
    df = frame(spark)
    parts = [P.profile(df.filter(F.pmod(F.xxhash64("code", "amount"), F.lit(3)) == i), COLUMNS) for i in range(3)]
    assert told(P.merge_profiles(parts)) == told(P.profile(df, COLUMNS))
    assert told(P.merge_profiles([P.merge_profiles(parts[:2]), parts[2]])) == told(P.profile(df, COLUMNS))


def test_what_is_told(spark):
    found = {(r["signature"], r["column"]): r for r in P.read_profile(P.profile(frame(spark), COLUMNS)).collect()}
    one = found["s0", "amount"]
    assert (one["n_rows"], one["n_nulls"], one["n_distinct"]) == (100, 25, 75) and one["quantiles"][0] == 3.0 and one["quantiles"][2] == 297.0
    alone = found["alone", "code"]
    assert (alone["n_rows"], alone["n_nulls"], alone["n_distinct"], alone["shapes"], alone["quantiles"]) == (1, 1, 0, [], None)
    assert found["s0", "code"]["shapes"][0]["shape"] == "U1\tD1" and found["s0", "code"]["shapes"][0]["n_rows"] == 80


def test_no_rows(spark):
    empty = P.profile(frame(spark).limit(0), COLUMNS)
    assert told(empty) == [] == told(P.merge_profiles([empty, empty]))
