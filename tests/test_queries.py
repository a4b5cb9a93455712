"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as registry
from rankflow.plans import graph, learning, oracles
from compare import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(graph.QUERIES) | set(learning.QUERIES) == set(oracles.sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(oracles.sql()))
def test_query(spark, connection, name):
    got = spark_rows(registry.queries()[name](spark, SF_DIR))
    assert got == sql_rows(connection, registry.oracle_sql()[name])
    assert got[1]


def test_entry(spark):
    assert registry.entry(spark).columns == ["node", "rank"]
