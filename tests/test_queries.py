"""Every registered query against DuckDB on the same tables."""

import __spark_entry__ as contract
import pytest

from quotelake.plans.catalog import ORACLES, QUERIES
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    difference = compare(spark, con, FOLDER, QUERIES[name], ORACLES[name])
    assert difference is None, difference


def test_every_query_is_in_the_contract():
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


def test_flagship_has_rows(spark):
    assert contract.entry(spark).columns == ["date", "cnt"]
    assert contract.entry(spark).count() > 0
