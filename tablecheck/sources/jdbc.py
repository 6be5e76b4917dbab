"""JDBC tables: parallel reads by any key, writes, and the keyed merge Spark lacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.sources.connection import (
    Options,
    add_hash_functions,
    add_unique_key,
    drop_table,
    execute,
    read_jdbc,
    read_jdbc_query,
    read_predicates,
    reader,
    table_exists,
    write_jdbc,
)
from tablecheck.sources.dialects import bucket_sql, literal, quoted, type_of_url
from tablecheck.sources.unit import DatabaseUnit, Key

__all__ = [
    "DatabaseUnit",
    "add_unique_key",
    "append_jdbc",
    "append_once_jdbc",
    "drop_table",
    "execute",
    "merge_jdbc",
    "read_bounds",
    "read_jdbc",
    "read_jdbc_balanced",
    "read_jdbc_hashed",
    "read_jdbc_partitioned",
    "read_jdbc_query",
    "replace_jdbc",
    "table_exists",
    "update_jdbc",
    "write_jdbc",
    "write_marks_jdbc",
]

#: Slots of the hash by which the rows of one key are told apart.
SLOTS = 1024

#: Types of keys that rows can be cut by: Spark and the database order them alike.
ORDERED = ("byte", "short", "integer", "long", "decimal", "float", "double", "date", "timestamp", "timestamp_ntz")


def read_bounds(
    spark: SparkSession, options: Options, table: str, column: str, where: str = ""
) -> DataFrame:
    """Smallest and largest partition column and row count, computed by the database."""
    name = quoted(type_of_url(options["url"]), column)
    condition = f" WHERE {where}" if where else ""
    row = read_jdbc_query(
        spark,
        options,
        f"SELECT MIN({name}) AS lower_bound, MAX({name}) AS upper_bound, "
        f"COUNT(*) AS row_count FROM {table}{condition}",
    ).toDF("lower_bound", "upper_bound", "row_count")
    return row.withColumn("row_count", F.col("row_count").cast("bigint"))


def _types(spark: SparkSession, options: Options, table: str) -> Mapping[str, str]:
    """Column names and types of a table, from the database's catalogue."""
    return {f.name: f.dataType.typeName() for f in read_jdbc(spark, options, table).schema}


def _tie_columns(types: Mapping[str, str], key: str) -> dict[str, str]:
    """What tells rows of one key apart: the short columns, else the texts, else the key."""
    others = {n: t for n, t in types.items() if n != key and t != "binary"}
    return {n: t for n, t in others.items() if t != "string"} or others or {key: types[key]}


def read_jdbc_hashed(
    spark: SparkSession,
    options: Options,
    table: str,
    columns: Key,
    partitions: int,
    where: str = "",
) -> DataFrame:
    """A table dealt to ``partitions`` connections by a hash of columns of any type.

    The database computes the hash in the condition of each connection, so no key has to be
    a number or to be numbered first; the price is that each connection looks at all rows
    (the index of a key cannot help). Name a second column where one value of the first has
    a large part of the rows. NULL is a value like any other.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    types = _types(spark, options, table)
    add_hash_functions(spark, options)
    bucket = bucket_sql(type_of_url(options["url"]), {n: types[n] for n in names}, partitions)
    also = f"({where}) AND " if where else ""
    return read_predicates(spark, options, table, [f"{also}{bucket} = {i}" for i in range(partitions)])


def read_jdbc_partitioned(
    spark: SparkSession,
    options: Options,
    table: str,
    column: str,
    partitions: int,
    bounds: tuple[object, object] | None = None,
    where: str = "",
) -> DataFrame:
    """A table in equal strides of a numeric, date or timestamp column.

    Bounds only place the strides; rows outside them, and NULLs, are read too.
    Without ``bounds`` the database is asked for them. Where there is nothing to stride
    over (all keys equal or NULL), rows are dealt by a hash of the other columns.
    """
    if bounds is None:
        row = read_bounds(spark, options, table, column, where).first()
        bounds = (row["lower_bound"], row["upper_bound"])
    if bounds[0] is None or bounds[0] == bounds[1]:
        ties = _tie_columns(_types(spark, options, table), column)
        return read_jdbc_hashed(spark, options, table, list(ties), partitions, where)
    source = f"(SELECT * FROM {table} WHERE {where}) src" if where else table
    return (
        reader(spark, options)
        .option("dbtable", source)
        .option("partitionColumn", column)
        .option("lowerBound", _bound(bounds[0]))
        .option("upperBound", _bound(bounds[1]))
        .option("numPartitions", partitions)
        .load()
    )


def _bound(value: object) -> str:
    """A bound as the source wants it: whole numbers, or a date or time as text."""
    return str(int(value)) if isinstance(value, Decimal | float) else str(value)


def read_jdbc_balanced(
    spark: SparkSession,
    options: Options,
    table: str,
    column: str,
    partitions: int,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """A table in ranges of about equal row count, however unevenly its key is filled.

    Stands in for numbering the rows inside the database, which sorts the whole table once
    per partition. Rows are cut by (key, hash of ``ties``), so a key that most rows share,
    or NULL, is cut too; a range inside one key looks at that key's rows only. Key and hash
    alone are read first, in parallel, and ranges of them made by a range shuffle, of which
    the driver sees the first value of each. ``ties`` defaults to the other columns, texts
    only if there are no others.
    """
    kind, types = type_of_url(options["url"]), _types(spark, options, table)
    if types[column] not in ORDERED:
        raise ValueError(f"{column} is {types[column]}; read it by read_jdbc_hashed")
    chosen = {n: types[n] for n in ties} if ties else _tie_columns(types, column)
    add_hash_functions(spark, options)
    name, slot = quoted(kind, column), bucket_sql(kind, chosen, SLOTS)
    edges = [SLOTS * i // partitions for i in range(partitions + 1)]
    dealt = [f"tc_slot >= {a} AND tc_slot < {b}" for a, b in zip(edges, edges[1:])]
    source = f"(SELECT {name} AS tc_key, {slot} AS tc_slot FROM {table}) src"
    keys = read_predicates(spark, options, source, dealt).toDF("tc_key", "tc_slot")
    ranged = keys.repartitionByRange(partitions, "tc_key", "tc_slot")
    first = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("*")).alias("first"))
    starts = first.select("first.*").distinct().orderBy("tc_key", "tc_slot").collect()
    cuts = [(r["tc_key"], int(r["tc_slot"])) for r in starts][1:]

    def below(key: object, place: int) -> str:
        if key is None:
            return f"({name} IS NULL AND {slot} < {place})"
        value = literal(kind, key)
        return f"({name} IS NULL OR {name} < {value} OR ({name} = {value} AND {slot} < {place}))"

    def from_(key: object, place: int) -> str:
        if key is None:
            return f"({name} IS NOT NULL OR {slot} >= {place})"
        value = literal(kind, key)
        return f"({name} > {value} OR ({name} = {value} AND {slot} >= {place}))"

    conditions = [[from_(*a)] if a else [] for a in [None, *cuts]]
    for condition, end in zip(conditions, cuts):
        condition.append(below(*end))
    return read_predicates(spark, options, table, [" AND ".join(c) or "1 = 1" for c in conditions])


def append_jdbc(
    df: DataFrame,
    options: Options,
    table: str,
    partitions: int | None = None,
    isolation: str | None = None,
    **extra: str,
) -> None:
    """Append all rows, equal ones included, each exactly once (see ``DatabaseUnit``)."""
    with DatabaseUnit(df.sparkSession, options, isolation) as unit:
        unit.append(df, table, partitions, **extra)
        unit.commit()


def replace_jdbc(
    df: DataFrame,
    options: Options,
    table: str,
    partitions: int | None = None,
    **extra: str,
) -> None:
    """Make the table anew with all rows, each exactly once."""
    write_jdbc(df.limit(0), options, table, "overwrite", **extra)
    append_jdbc(df, options, table, partitions, **extra)


def write_marks_jdbc(marks: DataFrame, options: Options, table: str, **extra: str) -> None:
    """Append to the mark table, isolation level SERIALIZABLE."""
    append_jdbc(marks, options, table, isolation="SERIALIZABLE", **extra)


def append_once_jdbc(
    df: DataFrame, options: Options, table: str, key: Key, partitions: int | None = None
) -> None:
    """Append the rows whose key is new; the whole job may run again after a failure."""
    with DatabaseUnit(df.sparkSession, options) as unit:
        unit.append_new(df, table, key, partitions)
        unit.commit()


def merge_jdbc(
    df: DataFrame, options: Options, table: str, key: Key, partitions: int | None = None
) -> None:
    """Update rows of ``table`` by key and insert new ones. ``df`` has one row per key."""
    with DatabaseUnit(df.sparkSession, options) as unit:
        unit.merge(df, table, key, partitions)
        unit.commit()


def update_jdbc(
    df: DataFrame, options: Options, table: str, key: Key, partitions: int | None = None
) -> None:
    """Update existing rows of ``table`` by key; a row deleted meanwhile stays gone."""
    with DatabaseUnit(df.sparkSession, options) as unit:
        unit.update(df, table, key, partitions)
        unit.commit()
