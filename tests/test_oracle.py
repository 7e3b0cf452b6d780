"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, connect  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_sql_is_complete():
    assert entry.REGISTRY.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
