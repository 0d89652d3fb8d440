"""Every registered query against its SQL."""

import os

import pytest
from oracle import compare, connect

from __spark_entry__ import SMOKE_TABLES, entry, oracle_sql, queries
from panelkit.registry import ORACLE as SQL
from panelkit.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", SMOKE_TABLES)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], SQL[name]) is None
