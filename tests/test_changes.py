"""Incremental triage: what is read, what a pass that dies leaves, and tables that were rewritten."""

import datetime as dt

from pyspark.sql import functions as F

from mendflow import schemas as S
from mendflow.plans.triage import triage_changes
from mendflow.sources import changes, tables
from tests.conftest import rows

DDL = "_row_id string, _generated_at timestamp, _data_source string, _error {0}, _warning {0}, v int".format(S.RESULT_DDL)
FQN, MARKS = "inc.quarantine.t", "inc.gov.marks"


def _append(spark, fqn, day, *ids):
    listed = [(i, dt.datetime(2024, 1, day), "s", [("rule", "m", "f", ["v"])], None, day) for i in ids]
    tables.append(spark.createDataFrame(listed, DDL), fqn)


def _empty(spark):
    return spark.createDataFrame([], S.QUEUE_DDL)


def test_a_pass_reads_what_is_new(spark):
    _append(spark, FQN, 1, "a", "b")
    first = triage_changes(spark, FQN, _empty(spark), MARKS, "r1")
    queue = tables.cut_lineage(first.new)
    assert rows(queue, "row_id") == [("a",), ("b",)]

    again = triage_changes(spark, FQN, queue, MARKS, "r1b")  # the first pass died before its mark
    assert len(again.appends) == 1 and again.new.isEmpty()
    again.done(queue)

    _append(spark, FQN, 2, "b", "c")
    second = triage_changes(spark, FQN, queue, MARKS, "r2")
    assert rows(second.rows, "_row_id", "v") == [("b", 2), ("c", 2)]
    assert rows(second.new, "row_id") == [("c",)]
    unread, names = changes.unread(spark, FQN, MARKS, FQN)
    assert len(names) == 1 and all(names[0] in f for f in unread.inputFiles())
    second.done(queue.unionByName(second.new))
    assert changes.unread(spark, FQN, MARKS, FQN)[1] == []
    assert triage_changes(spark, FQN, queue, MARKS, "r3").new.isEmpty()


def test_rewritten_tables_are_read_whole_and_marks_forget_what_is_gone(spark):
    fqn = "inc.quarantine.rewritten"
    _append(spark, fqn, 1, "a")
    _append(spark, fqn, 2, "b")
    done = triage_changes(spark, fqn, _empty(spark), MARKS, "r1")
    queue = tables.cut_lineage(done.new)
    done.done(queue)
    assert len(changes.marked(spark, MARKS, fqn)) == 2
    tables.replace(tables.read(spark, fqn), fqn)
    after = triage_changes(spark, fqn, queue, MARKS, "r2")
    assert after.rows.count() == 2 and after.new.isEmpty()
    after.done(queue)
    assert len(changes.marked(spark, MARKS, fqn)) == 1

    plain = "inc.quarantine.plain"
    tables.replace(tables.read(spark, fqn), plain)
    whole = triage_changes(spark, plain, _empty(spark), MARKS, "r1")
    assert whole.appends == [] and rows(whole.new, "row_id") == [("a",), ("b",)]
    whole.done(_empty(spark))


def test_newest_versions_of_some_rows(spark):
    from mendflow.operators.queue import latest_of

    fqn = "inc.quarantine.some"
    for day in (1, 2):
        _append(spark, fqn, day, "a", "b")
    ids = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "row_id string")
    assert rows(latest_of(tables.read(spark, fqn), ids), "row_id", "v") == [("a", 2)]
    assert latest_of(tables.read(spark, fqn), ids.filter(F.lit(False))).isEmpty()
