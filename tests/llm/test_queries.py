"""The registered corpus queries that SQL can express, against that SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from mendflow.llm.queries import ORACLES
from tests import oracle
from tests.llm.fixtures import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    problem, _ = oracle.compare(spark, oracle.connect(SF), SF, entry.queries()[name], ORACLES[name])
    assert problem is None, problem


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
