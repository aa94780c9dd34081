"""Queries of this subpackage that SQL can express, against DuckDB; and that all of them are registered."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from datashelf.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n.split("_")[0] for n in QUERIES]
    assert names == [f"op{i}" for i in range(1, 11)]
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None
