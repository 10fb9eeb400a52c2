"""Registered queries against their SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect

SMALL = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["o_orderkey", "raw0", "raw1", "p0", "p1", "prediction", "prob"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    fn, sql = contract.queries()[name], contract.oracle_sql().get(name)
    assert compare(spark, duck, SMALL, name, fn, sql) == ""
