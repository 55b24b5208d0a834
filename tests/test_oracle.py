"""Every registered query against its SQL twin on the shared tables."""

import os

import compare
import pytest

import __spark_entry__ as entry
from sparktally import catalog, oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
