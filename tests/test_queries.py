"""Every registered query of the library against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from verification.compare import connect, differences
from verification.oracle import ORACLE
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("key", [k for k in QUERIES if k in ORACLE])
def test_query_equals_sql(spark, connection, key):
    assert differences(QUERIES[key](spark, SF_DIR), connection, ORACLE[key]) == ""


def test_entry(spark):
    assert entry_point.entry(spark).columns[0] == "pickup_date"


def test_everything_is_registered():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLE)
