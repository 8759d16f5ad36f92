"""Every registered query gives the same rows as its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
import compare
from oracles.queries import expected_sql
from parcelhouse.queries import QUERIES



def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(expected_sql())
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small, name):
    assert compare.difference(spark, small, name) is None


def test_entry(spark, small):
    df = contract.entry(spark)
    assert df.columns == ["reconciliation_status", "orders", "net_difference", "share"]
    assert df.count() == 5
