"""Key checks together and over time: against single checks, plain counting, and restarts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mendflow.operators import checks as C
from mendflow.operators import keychecks, lookup
from mendflow.operators.history import KeyHistory
from mendflow.streaming import keyed_state
from mendflow.streaming.validate_stream import partitioned_sink, validate_stream
from tests.conftest import rows
from workloads.fixtures import check


@pytest.fixture(scope="module")
def messy(spark):
    rng = random.Random(4)
    pick = lambda *xs: rng.choice(xs)
    listed = [
        (i, pick(None, 1, 2, 3, rng.randrange(200)), pick(None, "a", "A", "b", f"x{rng.randrange(90)}"), pick(0.0, -0.0, float("nan"), 1.5, None))
        for i in range(600)
    ]
    return spark.createDataFrame(listed, "id int, k int, t string, d double").repartition(5)


def _refs(spark):
    return {
        "longs": spark.createDataFrame([(i,) for i in [*range(0, 150), None, 1, 1]], "key long"),
        "texts": spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "A"), (None, "a"), (7, "zz")], "k int, t string"),
    }


CHECKS = [
    check("pairs", "is_unique", columns=["k", "t"]),
    check("folded", "is_unique", columns=["t", "d"], ci_columns=["t"], nulls_distinct=False),
    check("number", "is_unique", column="d", criticality="warn"),
    check("known", "foreign_key", column="k", ref_table="longs", ref_column="key"),
    check("same", "sql_query", compare_column="t", other_table="texts", join_keys=["k"]),
]


@pytest.mark.parametrize("broadcast_bytes, task_rows", [(1 << 26, 1_000_000), (0, 7)])
def test_checks_together_equal_single_checks(spark, messy, monkeypatch, broadcast_bytes, task_rows):
    refs = _refs(spark)
    alone = Counter()
    for one in CHECKS:
        for r in C.evaluate(messy, [one], refs).collect():
            alone[r["id"]] |= 0
            for e in [*(r["_error"] or []), *(r["_warning"] or [])]:
                alone[r["id"], e["name"]] += 1
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(lookup, "TASK_ROWS", task_rows)
    together = Counter()
    for r in C.evaluate(messy, CHECKS, refs).collect():
        together[r["id"]] |= 0
        for e in [*(r["_error"] or []), *(r["_warning"] or [])]:
            together[r["id"], e["name"]] += 1
    assert together == alone and len({k[1] for k in alone if isinstance(k, tuple)}) == 5


def test_all_keys_are_counted_by_one_exchange(spark, messy):
    keyed = [keychecks._Keyed(messy, C.parse_check(c), _refs(spark)) for c in CHECKS]
    plan = keychecks.counted_keys(messy, keyed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_rows_and_unknown_tables(spark, messy):
    assert C.evaluate(messy.limit(0), CHECKS, _refs(spark)).count() == 0
    with pytest.raises(ValueError, match="longs"):
        C.evaluate(messy, CHECKS, {})
    with pytest.raises(ValueError, match="history|key counts"):
        C.evaluate(messy, [check("u", "is_unique", column="k", history="h")], {})


# --- over time ------------------------------------------------------------------------------------

UNIQUE = C.parse_check(check("u", "is_unique", column="k", history="h"))


def _keys(spark, values):
    return keychecks.unique_keys(spark.createDataFrame([(v,) for v in values], "k int"), UNIQUE)


def test_counts_are_kept_and_merged(spark):
    history = KeyHistory(spark, "hist.gov.counts", buckets=3, merge_after=2)
    rng, total = random.Random(6), Counter()
    for batch in range(7):
        values = [rng.randrange(30) for _ in range(20)] + [None]
        seen = history.at(batch)
        found = {r["k1"]: r["n"] for r in seen.earlier(_keys(spark, range(40))).collect()}
        known = {r["k1"]: v for v in range(40) for r in _keys(spark, [v]).collect()} if batch in (3, 6) else None
        if known:
            assert {known[k]: n for k, n in found.items()} == dict(total)
        for _ in range(2):  # each batch is delivered twice
            seen.record(_keys(spark, values))
        total.update(v for v in values if v is not None)


def test_a_merge_that_died_is_not_added_again(spark):
    history = KeyHistory(spark, "hist.gov.died", buckets=2, merge_after=50)
    for batch in range(3):
        history.record(_keys(spark, [1, 2, batch]), batch)
    history._merge(["0", "1"])
    history.record(_keys(spark, [1, 2, 0]), 0)  # as if the recent counts had not been dropped
    history._merge(["0", "1"])
    assert sorted(r["n"] for r in history.earlier(_keys(spark, [0, 1, 2])).collect()) == [1, 4, 4]


def test_stream_meets_earlier_batches(spark, tmp_path):
    schema = "id int, k int"
    batches = [[(1, 5), (2, 6)], [(3, 5), (4, 7), (5, 7)], [(6, 8), (7, 6), (8, None), (9, None)]]
    history = KeyHistory(spark, "hist.gov.stream", buckets=2)
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        sink = partitioned_sink(str(tmp_path / "good"), str(tmp_path / "bad"))
        unique = check("u", "is_unique", column="k", history="h")
        validate_stream(stream, [unique], "main.silver.x", sink, str(tmp_path / "cp"), "id", histories={"h": history}).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "bad")), "id") == [(3,), (4,), (5,), (7,)]
    assert rows(spark.read.parquet(str(tmp_path / "good")), "id") == [(1,), (2,), (6,), (8,), (9,)]


# --- state in a stream ----------------------------------------------------------------------------

def _stream(spark, folder, plan, batches):
    """Each batch is a run of its own: the query restarts from its checkpoint every time."""
    for batch in batches:
        spark.createDataFrame(batch, "id int, k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(folder / "in"))
        stream = plan(spark.readStream.schema("id int, k string, ts timestamp").parquet(str(folder / "in")))
        query = stream.writeStream.format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "cp"))
        query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(str(folder / "out"))


def _at(minute):
    import datetime

    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


BATCHES = [
    [(1, "a", _at(1)), (2, "b", _at(2)), (3, None, _at(3)), (4, None, _at(3))],
    [(5, "a", _at(8)), (6, "b", _at(70)), (7, "c", None)],
    [(8, "b", _at(5)), (9, "b", _at(75)), (10, "c", _at(200))],
    [(11, "c", _at(400))],
]


def test_repeated_keys_come_when_their_window_is_over(spark, tmp_path):
    found = _stream(spark, tmp_path, lambda s: keyed_state.repeated_keys_stream(s, ["k"], "ts", "1 hour", "10 minutes"), BATCHES)
    # Row 8 is an hour late, so the first window has one "b"; nulls are distinct keys.
    assert rows(found.select("k", "window_start", "n_rows")) == [("a", _at(0), 2), ("b", _at(60), 2)]


def test_first_rows_pass_and_keys_expire(spark, tmp_path):
    found = _stream(spark, tmp_path, lambda s: keyed_state.first_rows_stream(s.filter("k is not null and ts is not null"), ["k"], "ts", "30 minutes"), BATCHES)
    # Row 6 comes before the watermark lets go of "b", row 9 after; row 8 is late; row 11 is soon after row 10 by the watermark.
    assert rows(found, "id") == [(1,), (10,), (2,), (9,)]


def test_late_rows_are_found_in_the_stored_input(spark):
    stored = spark.createDataFrame([(i, *r) for i, b in enumerate(BATCHES) for r in b], "batch int, id int, k string, ts timestamp")
    assert rows(keyed_state.late_rows(stored, "batch", "ts", "10 minutes"), "id") == [(8,)]
    assert keyed_state.late_rows(stored.limit(0), "batch", "ts", "10 minutes").count() == 0
