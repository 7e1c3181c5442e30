"""Every registered query equals its SQL oracle on the smallest tables."""

import pytest
from harness import compare, connect

import __spark_entry__ as entry_file
from strucsift.checks.oracles import oracle_statements
from strucsift.checks.queries import QUERIES

ORACLES = oracle_statements()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLES) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, small, name):
    difference, _ = compare(spark, connection, name, QUERIES[name], ORACLES[name], small)
    assert difference is None


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
