"""Every registered query against its SQL, over the whole given tables."""

import pytest
from compare import differences

import __spark_entry__ as contract
from workload import monthly, weekly

# Queries of the optional corpus part are tested where that part is.
SQL = {**monthly.oracle_sql(), **weekly.oracle_sql()}
QUERIES = {**monthly.queries(), **weekly.queries()}


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    found, rows = differences(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert found is None
    assert rows > 0


def test_entry_runs(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "week_start"
    assert frame.count() > 0
