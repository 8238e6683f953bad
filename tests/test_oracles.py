"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, message
    assert "types" not in message, message


def test_entry(spark):
    assert entry.entry(spark).count() > 0
