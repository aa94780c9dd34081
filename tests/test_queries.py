"""Every registered query against its SQL, on the smallest data."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from shelf_queries.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["name", "year", "total_emissions"]
    assert 0 < df.count() <= 8


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None
