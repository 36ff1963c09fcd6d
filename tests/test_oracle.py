"""Every query with checking SQL, on the smallest tables."""

import pytest
from check_oracle import SMALL, compare, connect

import __spark_entry__ as entry
from editengine.plans.oracle import oracle

SQL = oracle()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SMALL), con, SQL[name]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_is_not_empty(spark):
    assert entry.entry(spark).count() == 426
