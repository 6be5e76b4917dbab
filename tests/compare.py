"""Runs a registered query and its SQL on the same tables and compares all rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def kinds(columns, rows) -> dict[str, set[str]]:
    return {
        name: {type(row[i]).__name__ for row in rows if row[i] is not None}
        for i, name in enumerate(columns)
    }


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir, run, sql) -> None:
    result = run(spark, sf_dir)
    spark_rows = [tuple(r) for r in result.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    assert sorted(result.columns) == sorted(names)
    assert len(spark_rows) == len(sql_rows)
    mine, theirs = rows_of(result.columns, spark_rows), rows_of(names, sql_rows)
    only_mine, only_theirs = mine - theirs, theirs - mine
    assert not only_mine and not only_theirs, (
        f"only in Spark: {list(only_mine)[:3]}, only in SQL: {list(only_theirs)[:3]}"
    )
    assert kinds(result.columns, spark_rows) == kinds(names, sql_rows)
