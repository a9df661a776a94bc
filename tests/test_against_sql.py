"""Every query with an SQL twin returns exactly the twin's rows."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from tallyloom.plans.oracle import all_oracles
from tallyloom.plans.queries import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
