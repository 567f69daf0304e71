"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import pytest
from checks.oracle import ORACLE
from checks.queries import REGISTRY
from compare import connect, difference


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, con, name):
    assert difference(REGISTRY[name](spark, small), con, ORACLE[name]) == ""


def test_sql_names_are_queries():
    assert set(ORACLE) <= set(REGISTRY)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
