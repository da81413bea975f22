"""Every registered query against its SQL on the smallest data."""

import os

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE_SQL
from checks.registry import registered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", registered())
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) is None


def test_every_sql_belongs_to_a_query():
    assert set(registered()) == set(ORACLE_SQL)
