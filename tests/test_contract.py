"""Every query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from checks.compare import database, differences

DATA = "/root/testdata/sf0.001"
QUERIES = contract.queries()
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(DATA)


def test_every_query_has_sql():
    """But for those of the training-data part, which has tests of its own."""
    assert {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)} <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_its_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, SQL[name]) == []


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "snapshot_date" and result.count() > 0
