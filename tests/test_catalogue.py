"""Every registered query against its SQL on the smallest data, value by value."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from spendlens.plans.queries import CHECK_SQL, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_equals_sql(spark, con, small, name):
    assert differences(QUERIES[name](spark, small), con, CHECK_SQL[name]) == []


def test_entry_points(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.oracle_sql())
