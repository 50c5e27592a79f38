"""Every registered query equals its SQL on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from jatoba.queries import QUERIES, SQL  # noqa: E402
from tests.oracle import SF_DIR, compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def connection():
    yield connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, QUERIES[name], SQL[name], SF_DIR) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
