"""Every query with SQL, against DuckDB on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    rows, missing, extra, notes = differences(
        spark, connection, QUERIES[name], ORACLES[name], SF_DIR
    )
    assert (missing, extra, notes) == ({}, {}, "")
    assert rows > 0
