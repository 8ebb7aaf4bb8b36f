"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = f"{oracle.TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.CORPUS_QUERIES)))
def test_query_matches_sql(spark, con, name):
    problem, _ = oracle.compare(
        spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql().get(name)
    )
    assert problem is None, problem


def test_every_query_has_sql_but_some_on_corpora():
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert without <= set(entry.CORPUS_QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
