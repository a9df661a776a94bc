"""Corpus queries with an SQL twin return exactly the twin's rows."""

import os

import pytest
from compare import connect, differences

from tallyloom.llm.oracle import ORACLES
from tallyloom.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    with connect(SF_DIR) as con:
        assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


def test_all_operators():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
