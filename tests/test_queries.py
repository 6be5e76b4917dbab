"""Every registered query against its SQL at sf0.01."""

from __future__ import annotations

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as driver

QUERIES = driver.QUERIES
ORACLE = driver.ORACLE


@pytest.fixture(scope="module")
def connection(sf_dir):
    with oracle_connection(sf_dir) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, connection, sf_dir, name):
    compare(spark, connection, sf_dir, QUERIES[name], ORACLE[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    row = driver.entry(spark).first()
    assert row["total"] == row["legal"] + row["illegal"] + row["null_or_empty"]
