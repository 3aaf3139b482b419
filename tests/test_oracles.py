"""Every registered query against its SQL, on the smallest tables."""

import compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    wrong = compare.difference(spark, connection, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert wrong is None, wrong


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
