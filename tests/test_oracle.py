"""Every registered query against its SQL on the smallest test data."""

from pathlib import Path

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from tradeloom.oracle.registry import oracle_statements
from tradeloom.plans.registry import registered_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered_queries()) == set(oracle_statements())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == ""


def test_flagship_runs(spark):
    assert entry(spark).count() == 10
