"""A JDBC database as it is: plain reads and writes, statements, what tables there are."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from tablecheck.sources.dialects import DERBY_FUNCTIONS, FETCH_SIZE, type_of_url, unique_key_sql

Options = Mapping[str, str]


def reader(spark: SparkSession, options: Options) -> DataFrameReader:
    return spark.read.format("jdbc").option("fetchsize", FETCH_SIZE).options(**options)


def read_jdbc(spark: SparkSession, options: Options, table: str) -> DataFrame:
    """A whole table through one connection.

    Filters and columns of the returned DataFrame are pushed to the database. For
    a large table use one of the partitioned reads.
    """
    return reader(spark, options).option("dbtable", table).load()


def read_jdbc_query(spark: SparkSession, options: Options, query: str) -> DataFrame:
    """A SELECT that runs in the database."""
    return reader(spark, options).option("query", query).load()


def read_predicates(
    spark: SparkSession, options: Options, table: str, predicates: Sequence[str]
) -> DataFrame:
    """One partition, read through a connection of its own, for each condition."""
    others = {k: v for k, v in options.items() if k != "url"}
    others["fetchsize"] = str(FETCH_SIZE)
    return spark.read.jdbc(options["url"], table, predicates=list(predicates), properties=others)


def write_jdbc(
    df: DataFrame,
    options: Options,
    table: str,
    mode: str = "append",
    partitions: int | None = None,
    **extra: str,
) -> None:
    """Write through one connection per partition.

    A retried task writes its rows again; a ``DatabaseUnit`` does not let that reach
    the target.
    """
    writer = df.write.format("jdbc").mode(mode).option("dbtable", table)
    if partitions:
        writer = writer.option("numPartitions", partitions)
    writer.options(**options, **extra).save()


@contextmanager
def connected(spark: SparkSession, options: Options) -> Iterator:
    """A connection of the driver. No rows of a table pass it."""
    jvm = spark._jvm
    login = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            login.setProperty(name, options[name])
    # The driver class may come from --jars, which only this loader sees.
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = loader.loadClass(options["driver"]).newInstance()
    connection = driver.connect(options["url"], login)
    if connection is None:
        raise ValueError("the JDBC driver does not accept the URL")
    try:
        yield connection
    finally:
        connection.close()


def execute(
    spark: SparkSession,
    options: Options,
    statements: Sequence[str],
    isolation: str | None = None,
) -> None:
    """Run statements in one transaction, once, from the driver."""
    with connected(spark, options) as connection:
        connection.setAutoCommit(False)
        try:
            if isolation:
                level = getattr(spark._jvm.java.sql.Connection, f"TRANSACTION_{isolation}")
                connection.setTransactionIsolation(level)
            statement = connection.createStatement()
            for sql in statements:
                statement.execute(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise


def table_exists(spark: SparkSession, options: Options, table: str) -> bool:
    """Asks the catalogue of the database; any failure to do so is an error."""
    with connected(spark, options) as connection:
        about = connection.getMetaData()

        def stored(name: str) -> str | None:
            if about.storesUpperCaseIdentifiers():
                name = name.upper()
            elif about.storesLowerCaseIdentifiers():
                name = name.lower()
            return name or None

        schema, _, bare = table.rpartition(".")
        place, name = stored(schema), stored(bare)
        # MySQL calls a schema a catalogue
        catalogue, place = (place, None) if type_of_url(options["url"]) == "mysql" else (None, place)
        return name in _found(about.getTables(catalogue, place, name, None), "TABLE_NAME")


def _found(results, column: str) -> set[str]:
    """Names in an answer of the catalogue, which reads ``_`` in a name as any character."""
    names = set()
    while results.next():
        names.add(results.getString(column))
    return names


def drop_table(spark: SparkSession, options: Options, table: str) -> None:
    """Drop a table if it is there."""
    if table_exists(spark, options, table):
        execute(spark, options, [f"DROP TABLE {table}"])


def add_unique_key(
    spark: SparkSession, options: Options, table: str, key: str | Sequence[str]
) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    execute(spark, options, [unique_key_sql(type_of_url(options["url"]), table, keys)])


def add_hash_functions(spark: SparkSession, options: Options) -> None:
    """Declare the functions a hash needs where the database has none of its own."""
    if type_of_url(options["url"]) != "derby":
        return
    with connected(spark, options) as connection:
        there = _found(connection.getMetaData().getFunctions(None, None, "TC%"), "FUNCTION_NAME")
        for name, sql in DERBY_FUNCTIONS.items():
            if name not in there:
                connection.createStatement().execute(sql)


def count_rows(spark: SparkSession, options: Options, table: str) -> int:
    return int(read_jdbc_query(spark, options, f"SELECT COUNT(*) AS n FROM {table}").first()[0])
