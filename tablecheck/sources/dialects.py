"""Connection options and SQL text per kind of database."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

FETCH_SIZE = 5000

# Driver class by the start of a JDBC URL. Order matters.
DRIVERS = {
    "jdbc:oracle": "oracle.jdbc.driver.OracleDriver",
    "jdbc:dm": "dm.jdbc.driver.DmDriver",
    "jdbc:microsoft:sqlserver": "com.microsoft.jdbc.sqlserver.SQLServerDriver",
    "jdbc:sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "jdbc:postgresql": "org.postgresql.Driver",
    "jdbc:hive2": "org.apache.hive.jdbc.HiveDriver",
    "jdbc:derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    "jdbc:mysql": "com.mysql.jdbc.Driver",
}
DEFAULT_DRIVER = "com.mysql.jdbc.Driver"

# URL forms.
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
    "oracle": "jdbc:oracle:thin:@{host}:{port}/{database}",
    "oracle_sid": "jdbc:oracle:thin:@{host}:{port}:{database}",
    "dameng": "jdbc:dm://{host}:{port}",
}
MYSQL_PARAMETERS = {"useUnicode": "true", "characterEncoding": "utf8"}

METASTORE_TYPES = ("hive", "hive2")


def canonical_type(db_type: str) -> str:
    """Lower-case kind of database; Greenplum speaks PostgreSQL."""
    name = db_type.lower()
    name = "postgresql" if name == "greenplum" else name
    known = ("mysql", "postgresql", "oracle", "dameng", "derby", "sqlserver", *METASTORE_TYPES)
    if name not in known:
        raise ValueError(f"unknown kind of database: {db_type!r}")
    return name


def jdbc_url(
    db_type: str, host: str, port: int | str, database: str, service_style: str = "service"
) -> str:
    """``service_style`` matters to Oracle only: ``service`` or ``sid``."""
    kind = canonical_type(db_type)
    if kind == "oracle" and service_style.lower() == "sid":
        kind = "oracle_sid"
    if kind not in URLS:
        raise ValueError(f"{db_type} has no host and port URL")
    return URLS[kind].format(host=host, port=port, database=database)


def driver_of(url: str) -> str:
    for start, driver in DRIVERS.items():
        if url.startswith(start):
            return driver
    return DEFAULT_DRIVER


def refined_url(url: str) -> str:
    """A MySQL URL with the character set parameters it lacks; a parameter that is there
    keeps its value."""
    if not url.startswith("jdbc:mysql"):
        return url
    missing = [f"{k}={v}" for k, v in MYSQL_PARAMETERS.items() if not re.search(f"[?&]{k}=", url)]
    if not missing:
        return url
    return url + ("&" if "?" in url else "?") + "&".join(missing)


def options_from_url(
    url: str, user: str | None = None, password: str | None = None, **extra: str
) -> dict[str, str]:
    """Options of the ``jdbc`` source for a caller's URL and login."""
    options = {"url": refined_url(url), "driver": driver_of(url), **extra}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def jdbc_options(
    db_type: str,
    host: str,
    port: int | str,
    database: str,
    user: str | None = None,
    password: str | None = None,
    service_style: str = "service",
) -> dict[str, str]:
    return options_from_url(
        jdbc_url(db_type, host, port, database, service_style), user, password
    )


def type_of_url(url: str) -> str:
    """Kind of database a JDBC URL points to."""
    for kind in ("oracle", "postgresql", "derby", "mysql"):
        if url.startswith(f"jdbc:{kind}"):
            return kind
    if url.startswith("jdbc:dm"):
        return "dameng"
    if url.startswith(("jdbc:sqlserver", "jdbc:microsoft:sqlserver")):
        return "sqlserver"
    raise ValueError("this kind of database is not supported")


def default_mark_table(db_type: str, source_table: str, mark_table: str = "") -> str:
    """``CHK_<source table>``; Oracle and Dameng drop the schema name."""
    if mark_table.strip():
        return mark_table
    bare = canonical_type(db_type) in ("oracle", "dameng")
    return "CHK_" + (source_table.split(".")[-1] if bare else source_table)


def quoted(db_type: str, name: str) -> str:
    mark = "`" if db_type == "mysql" else '"'
    return mark + name.replace(mark, mark * 2) + mark


def literal(db_type: str, value: object) -> str:
    """A number, date or time as SQL text."""
    if isinstance(value, bool) or not isinstance(value, int | float | Decimal | date):
        raise ValueError(f"no literal of this type: {type(value).__name__}")
    if isinstance(value, datetime):
        kind, text = "TIMESTAMP", f"{value:%Y-%m-%d %H:%M:%S.%f}"
    elif isinstance(value, date):
        kind, text = "DATE", f"{value:%Y-%m-%d}"
    else:
        return format(value, "f") if isinstance(value, Decimal) else repr(value)
    if db_type == "derby":
        return f"{kind}('{text}')"
    if db_type == "sqlserver":
        return f"CAST('{text}' AS {'DATETIME2' if kind == 'TIMESTAMP' else kind})"
    return f"{kind} '{text}'"


# The hash of a value as text, a whole number within 32 bits and a sign.
HASHES = {
    "mysql": "CAST(CRC32({0}) AS SIGNED)",
    "postgresql": "CAST(hashtext(CAST({0} AS text)) AS bigint)",
    "oracle": "ORA_HASH({0})",
    "dameng": "ORA_HASH({0})",
    "sqlserver": "CAST(CAST(SUBSTRING(HASHBYTES('MD5', CAST({0} AS NVARCHAR(4000))), 1, 4) AS INT)"
    " AS BIGINT)",
    "derby": "CAST(TC_HASH({0}) AS BIGINT)",
}

# Derby has no hash; these are static methods of libraries Spark comes with.
DERBY_FUNCTIONS = {
    "TC_HASH": "CREATE FUNCTION TC_HASH(V VARCHAR(32672)) RETURNS INTEGER LANGUAGE JAVA "
    "PARAMETER STYLE JAVA NO SQL RETURNS NULL ON NULL INPUT "
    "EXTERNAL NAME 'org.apache.commons.codec.digest.MurmurHash2.hash32'",
    "TC_TEXT": "CREATE FUNCTION TC_TEXT(V DOUBLE) RETURNS VARCHAR(40) LANGUAGE JAVA "
    "PARAMETER STYLE JAVA NO SQL RETURNS NULL ON NULL INPUT "
    "EXTERNAL NAME 'java.lang.Double.toString'",
}

# Weights of the columns of a hash; primes, so that equal values do not cancel out.
WEIGHTS = (7919, 104_729, 15_485_863, 32_452_843, 49_979_687, 67_867_967, 86_028_121, 122_949_823)


def hash_sql(db_type: str, column: str, data_type: str) -> str:
    """A whole number that depends on the value of a column; NULL counts as zero."""
    kind, value = canonical_type(db_type), quoted(canonical_type(db_type), column)
    if kind != "derby":
        return f"COALESCE({HASHES[kind].format(value)}, 0)"
    if data_type in ("float", "double"):
        text = f"TC_TEXT({value})"
    else:
        text = f"CAST({value} AS {'VARCHAR(32672)' if data_type == 'string' else 'CHAR(40)'})"
    return f"COALESCE({HASHES[kind].format(text)}, 0)"


def bucket_sql(db_type: str, types: Mapping[str, str], buckets: int) -> str:
    """The bucket, from 0, of a row by the values of its columns (name -> type)."""
    if not types:
        raise ValueError("no column to deal rows by")
    parts = [
        f"{WEIGHTS[i % len(WEIGHTS)]} * {hash_sql(db_type, name, kind)}"
        for i, (name, kind) in enumerate(types.items())
    ]
    total = f"ABS({' + '.join(parts)})"
    if canonical_type(db_type) == "sqlserver":
        return f"({total} % {buckets})"
    return f"MOD({total}, {buckets})"


def empty_like_sql(
    db_type: str, table: str, columns: Sequence[str], new: str, position: str
) -> str:
    """A new table with some columns of another one, of their types, and a position."""
    kind = canonical_type(db_type)
    listed = ", ".join(quoted(kind, c) for c in columns)
    whole = {"mysql": "SIGNED", "oracle": "NUMBER(19)"}.get(kind, "BIGINT")
    chosen = f"SELECT {listed}, CAST(0 AS {whole}) AS {quoted(kind, position)}"
    if kind == "sqlserver":
        return f"{chosen} INTO {new} FROM {table} WHERE 1 = 0"
    if kind == "derby":
        return f"CREATE TABLE {new} AS {chosen} FROM {table} WITH NO DATA"
    return f"CREATE TABLE {new} AS {chosen} FROM {table} WHERE 1 = 0"


def rename_sql(db_type: str, table: str, new: str) -> str:
    kind, bare = canonical_type(db_type), new.split(".")[-1]
    if kind == "sqlserver":
        return f"EXEC sp_rename '{table}', '{bare}'"
    if kind == "mysql":
        return f"RENAME TABLE {table} TO {new}"
    if kind == "derby":
        return f"RENAME TABLE {table} TO {bare}"
    return f"ALTER TABLE {table} RENAME TO {bare}"


def lacks_on_conflict(version: str) -> bool:
    """Whether a database of the PostgreSQL family is too old for ``ON CONFLICT``."""
    found = re.search(r"Greenplum Database (\d+)", version)
    if found:
        return int(found[1]) < 7
    found = re.search(r"PostgreSQL (\d+)(?:\.(\d+))?", version)
    return bool(found) and (int(found[1]), int(found[2] or 0)) < (9, 5)


def staging_name(table: str) -> str:
    """An unused table name next to ``table``; short enough for old Oracle."""
    schema, dot, _ = table.rpartition(".")
    return f"{schema}{dot}TC_{uuid.uuid4().hex[:16].upper()}"


def unique_key_sql(db_type: str, table: str, key: Sequence[str]) -> str:
    """The unique index that a keyed update needs to be fast, or to work at all."""
    kind = canonical_type(db_type)
    columns = ", ".join(quoted(kind, k) for k in key)
    return f"CREATE UNIQUE INDEX IX_{table.split('.')[-1]} ON {table} ({columns})"


def _require_key(columns: Sequence[str], key: Sequence[str]) -> None:
    missing = [k for k in key if k not in columns]
    if missing or not key:
        raise ValueError(f"key columns are not in the updates: {missing or 'no key'}")


def insert_all_sql(db_type: str, table: str, staging: str, columns: Sequence[str]) -> str:
    """One statement that appends the named columns of all staged rows."""
    listed = ", ".join(quoted(canonical_type(db_type), c) for c in columns)
    return f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging}"


def insert_new_sql(
    db_type: str, table: str, staging: str, columns: Sequence[str], key: Sequence[str]
) -> str:
    """One statement that inserts the rows whose key ``table`` does not hold yet."""
    kind = canonical_type(db_type)
    _require_key(columns, key)
    listed = ", ".join(quoted(kind, c) for c in columns)
    matched = " AND ".join(f"t.{quoted(kind, k)} = s.{quoted(kind, k)}" for k in key)
    return (
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {matched})"
    )


def merge_sql(
    db_type: str, table: str, staging: str, columns: Sequence[str], key: Sequence[str]
) -> str:
    """One statement that updates rows of ``table`` by key and inserts new ones.

    MySQL and PostgreSQL need a unique index on the key.
    """
    kind = canonical_type(db_type)
    _require_key(columns, key)
    names = [quoted(kind, c) for c in columns]
    keys = [quoted(kind, k) for k in key]
    others = [n for n in names if n not in keys]
    listed = ", ".join(names)
    if kind == "mysql":
        changes = others or keys[:1]
        sets = ", ".join(f"{n} = VALUES({n})" for n in changes)
        return (
            f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} "
            f"ON DUPLICATE KEY UPDATE {sets}"
        )
    if kind == "postgresql":
        sets = ", ".join(f"{n} = EXCLUDED.{n}" for n in others)
        action = f"DO UPDATE SET {sets}" if others else "DO NOTHING"
        return (
            f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} "
            f"ON CONFLICT ({', '.join(keys)}) {action}"
        )
    matched = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{n} = s.{n}" for n in others)
    update = f"WHEN MATCHED THEN UPDATE SET {sets} " if others else ""
    values = ", ".join(f"s.{n}" for n in names)
    return (
        f"MERGE INTO {table} t USING {staging} s ON ({matched}) {update}"
        f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({values}){_end(kind)}"
    )


def merge_statements(
    db_type: str,
    table: str,
    staging: str,
    columns: Sequence[str],
    key: Sequence[str],
    old: bool = False,
) -> list[str]:
    """``merge_sql``, or an update and an insert where the database is too old for it."""
    if not old:
        return [merge_sql(db_type, table, staging, columns, key)]
    insert = insert_new_sql(db_type, table, staging, columns, key)
    if all(c in key for c in columns):
        return [insert]
    return [update_sql(db_type, table, staging, columns, key), insert]


def update_sql(
    db_type: str, table: str, staging: str, columns: Sequence[str], key: Sequence[str]
) -> str:
    """One statement that updates rows of ``table`` by key and inserts none.

    The staged columns may be a part of the table's; a row deleted meanwhile stays gone.
    """
    kind = canonical_type(db_type)
    _require_key(columns, key)
    keys = [quoted(kind, k) for k in key]
    others = [quoted(kind, c) for c in columns if c not in key]
    if not others:
        raise ValueError("there is no column to update besides the key")
    matched = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    if kind == "mysql":
        sets = ", ".join(f"t.{n} = s.{n}" for n in others)
        return f"UPDATE {table} t JOIN {staging} s ON {matched} SET {sets}"
    sets = ", ".join(f"{n} = s.{n}" for n in others)
    if kind == "postgresql":
        return f"UPDATE {table} AS t SET {sets} FROM {staging} AS s WHERE {matched}"
    return (
        f"MERGE INTO {table} t USING {staging} s ON ({matched}) "
        f"WHEN MATCHED THEN UPDATE SET {sets}{_end(kind)}"
    )


def _end(kind: str) -> str:
    return ";" if kind == "sqlserver" else ""
