"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry_points
from oracle import connect, differences

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("key", [key for key in QUERIES if key in ORACLES])
def test_query_agrees_with_sql(spark, folder, con, key):
    assert differences(QUERIES[key](spark, folder), con, ORACLES[key]) == []


def test_entry_runs(spark):
    (row,) = entry_points.entry(spark).collect()
    assert 0 < row.n_matched < row.n_rows
