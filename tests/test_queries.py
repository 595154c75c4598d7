"""Every registered query against its SQL, and the contract of the entry module."""

import pytest

import __spark_entry__ as contract
import oracle
from contract import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, sf, name):
    assert oracle.difference(QUERIES[name](spark, sf), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
