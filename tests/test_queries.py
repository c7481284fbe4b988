"""Every registered query against DuckDB on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def test_every_query_has_a_statement():
    assert set(entry._QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry._QUERIES))
def test_query_matches(spark, con, name):
    assert compare.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name],
                           FOLDER) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "late_rate" in df.columns
