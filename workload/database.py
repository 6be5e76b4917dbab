"""The database the JDBC queries use.

A cluster names one in ``spark.tablecheck.jdbc.url`` (with ``.user`` and
``.password``) that every executor reaches. Only where driver and executors are
one process, as in tests, an embedded in-memory database stands in: no server, no
port, and no other process sees it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablecheck.session import is_single_process
from tablecheck.sources.dialects import options_from_url
from tablecheck.sources.connection import add_unique_key, write_jdbc

SETTING = "spark.tablecheck.jdbc"
EMBEDDED = "jdbc:derby:memory:tablecheck;create=true"
PARTITIONS = 4


# Times come back as they were written, whatever the time zone of the session.
READ_OPTIONS = {"preferTimestampNTZ": "true"}


def database(spark: SparkSession) -> dict[str, str]:
    url = spark.conf.get(f"{SETTING}.url", None)
    if url:
        user = spark.conf.get(f"{SETTING}.user", None)
        password = spark.conf.get(f"{SETTING}.password", None)
        return options_from_url(url, user, password, **READ_OPTIONS)
    if not is_single_process(spark):
        raise RuntimeError(f"set {SETTING}.url to a database that all executors reach")
    return options_from_url(EMBEDDED, **READ_OPTIONS)


def key_types(df: DataFrame, key: str) -> dict[str, str]:
    """The longest short text for a text key: the embedded database indexes no other. All
    other texts are of its long type, which takes NULL and any length."""
    is_text = df.schema[key].dataType.typeName() == "string"
    return {"createTableColumnTypes": f"`{key}` VARCHAR(32672)"} if is_text else {}


def load(
    df: DataFrame,
    table: str,
    types: dict[str, str] | None = None,
    key: str | None = None,
) -> dict[str, str]:
    """Put all rows of ``df`` into a table of the database; returns its options.

    ``key`` gets a unique index. ``types``: column types, by default those of the key.
    """
    options = database(df.sparkSession)
    types = (key_types(df, key) if key else {}) if types is None else types
    write_jdbc(df, options, table, "overwrite", PARTITIONS, **types)
    if key:
        add_unique_key(df.sparkSession, options, table, key)
    return options
