"""Every registered query against its SQL on the shared tables."""

import pytest

import __spark_entry__ as contract
from checks import compare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(compare.ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(spark, connection, SF, name) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(compare.QUERIES) == set(compare.ORACLE_SQL)
    assert contract.entry(spark).count() == 11
