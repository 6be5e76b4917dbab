from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck import session
from tablecheck.sources import dialects, files, jdbc, jsonlines, tables, unit
from workload.database import database, load
from workload.tables import dirty_customer


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Options and SQL text


@pytest.mark.parametrize(
    "kind, style, url, driver",
    [
        ("MYSQL", "service", "jdbc:mysql://h:1/d?useUnicode=true&characterEncoding=utf8", "com.mysql.jdbc.Driver"),
        ("oracle", "sid", "jdbc:oracle:thin:@h:1:d", "oracle.jdbc.driver.OracleDriver"),
        ("ORACLE", "service", "jdbc:oracle:thin:@h:1/d", "oracle.jdbc.driver.OracleDriver"),
        ("Greenplum", "service", "jdbc:postgresql://h:1/d", "org.postgresql.Driver"),
        ("postgresql", "service", "jdbc:postgresql://h:1/d", "org.postgresql.Driver"),
        ("DAMENG", "service", "jdbc:dm://h:1", "dm.jdbc.driver.DmDriver"),
    ],
)
def test_options_per_database(kind, style, url, driver):
    options = dialects.jdbc_options(kind, "h", 1, "d", "u", "p", style)
    assert options == {"url": url, "driver": driver, "user": "u", "password": "p"}


def test_unknown_database():
    for kind in ("hbase", ""):
        with pytest.raises(ValueError):
            dialects.jdbc_options(kind, "h", 1, "d")
    with pytest.raises(ValueError):
        dialects.jdbc_url("hive2", "h", 1, "d")
    with pytest.raises(ValueError):
        dialects.type_of_url("jdbc:db2://h")
    assert dialects.type_of_url("jdbc:sqlserver://h") == "sqlserver"


@pytest.mark.parametrize(
    "url, driver",
    [
        ("jdbc:microsoft:sqlserver://h", "com.microsoft.jdbc.sqlserver.SQLServerDriver"),
        ("jdbc:sqlserver://h", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
        ("jdbc:hive2://h", "org.apache.hive.jdbc.HiveDriver"),
        ("jdbc:other://h", "com.mysql.jdbc.Driver"),
    ],
)
def test_driver_of_url(url, driver):
    assert dialects.driver_of(url) == driver


@pytest.mark.parametrize(
    "url, refined",
    [
        ("jdbc:mysql://h/d?a=b", "jdbc:mysql://h/d?a=b&useUnicode=true&characterEncoding=utf8"),
        ("jdbc:mysql://h/d?useUnicode=true", "jdbc:mysql://h/d?useUnicode=true&characterEncoding=utf8"),
        (
            "jdbc:mysql://h/d?useUnicode=true&characterEncoding=utf8",
            "jdbc:mysql://h/d?useUnicode=true&characterEncoding=utf8",
        ),
        ("jdbc:postgresql://h/d", "jdbc:postgresql://h/d"),
        (
            "jdbc:mysql://h/d?characterEncoding=gbk",
            "jdbc:mysql://h/d?characterEncoding=gbk&useUnicode=true",
        ),
    ],
)
def test_character_set_parameters(url, refined):
    assert dialects.refined_url(url) == refined


def test_mark_table_name():
    assert dialects.default_mark_table("oracle", "S.T") == "CHK_T"
    assert dialects.default_mark_table("dameng", "T") == "CHK_T"
    assert dialects.default_mark_table("mysql", "S.T") == "CHK_S.T"
    assert dialects.default_mark_table("mysql", "T", "MINE") == "MINE"
    assert dialects.default_mark_table("hive", "T", "  ") == "CHK_T"


def test_merge_text_per_database():
    def sql(kind, columns=("k", "v")):
        return dialects.merge_sql(kind, "t", "s", columns, ["k"])

    assert sql("mysql") == (
        "INSERT INTO t (`k`, `v`) SELECT `k`, `v` FROM s ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    )
    assert sql("greenplum") == (
        'INSERT INTO t ("k", "v") SELECT "k", "v" FROM s '
        'ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"'
    )
    assert sql("postgresql", ("k",)).endswith('ON CONFLICT ("k") DO NOTHING')
    assert sql("oracle") == (
        'MERGE INTO t t USING s s ON (t."k" = s."k") WHEN MATCHED THEN UPDATE SET "v" = s."v" '
        'WHEN NOT MATCHED THEN INSERT ("k", "v") VALUES (s."k", s."v")'
    )
    with pytest.raises(ValueError):
        dialects.merge_sql("oracle", "t", "s", ["v"], ["k"])
    assert dialects.quoted("mysql", "a`b") == "`a``b`"
    assert dialects.staging_name("S.T").startswith("S.TC_")
    assert len(dialects.staging_name("T")) <= 30


# Embedded database


def test_partitioned_read_is_whole(spark):
    df = spark.range(-50, 1000).select("id", (F.col("id") * 3).alias("v"))
    options = load(df, "T_PARTS")
    for bounds in (None, (0, 100), (5, 5)):
        got = jdbc.read_jdbc_partitioned(spark, options, "T_PARTS", "id", 5, bounds)
        assert rows(got) == rows(df)
        assert got.rdd.getNumPartitions() == 5
    some = jdbc.read_jdbc_partitioned(spark, options, "T_PARTS", "id", 3, where='"id" >= 990')
    assert rows(some) == rows(df.where("id >= 990"))
    assert tuple(jdbc.read_bounds(spark, options, "T_PARTS", "id", '"id" > 10').first()) == (11, 999, 989)


def test_partitioned_read_by_other_types(spark):
    df = spark.range(200).select(
        F.col("id").cast("decimal(20,4)").alias("d"),
        F.col("id").cast("double").alias("f"),
        F.timestamp_seconds(F.col("id") * 86_400).cast("timestamp_ntz").alias("t"),
    )
    options = load(df, "T_TYPES")
    with_zone = {**options, "preferTimestampNTZ": "false"}
    for column, chosen in (("d", options), ("f", options), ("t", with_zone)):
        got = jdbc.read_jdbc_partitioned(spark, chosen, "T_TYPES", column, 4)
        assert got.rdd.getNumPartitions() == 4
        assert rows(got.select("d", "f")) == rows(df.select("d", "f"))
    for column in ("d", "f"):
        assert rows(jdbc.read_jdbc_balanced(spark, options, "T_TYPES", column, 4)) == rows(df)


def test_partitioned_read_of_an_empty_table(spark):
    options = load(spark.range(0), "T_EMPTY")
    assert jdbc.read_jdbc_partitioned(spark, options, "T_EMPTY", "id", 4).count() == 0
    assert jdbc.read_jdbc_balanced(spark, options, "T_EMPTY", "id", 4).count() == 0


def test_balanced_read_has_even_partitions(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") < 3900, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("k")
    ).unionByName(spark.sql("SELECT cast(NULL AS bigint) AS k"))
    options = load(df, "T_BALANCED")
    got = jdbc.read_jdbc_balanced(spark, options, "T_BALANCED", "k", 4)
    assert rows(got) == rows(df)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1500


def partition_sizes(df):
    found = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in found)


def test_hashed_read_of_a_text_key(spark):
    """A third of the keys are one text, a third NULL; a second column tells them apart."""
    df = spark.range(6000).select(
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN 'key ' || id END").alias("k"), "id"
    )
    options = load(df, "T_HASHED", types={})
    got = jdbc.read_jdbc_hashed(spark, options, "T_HASHED", ["k", "id"], 5)
    assert rows(got) == rows(df)
    sizes = partition_sizes(got)
    assert len(sizes) == 5 and sizes[-1] < 1.2 * sizes[0]
    alone = jdbc.read_jdbc_hashed(spark, options, "T_HASHED", "k", 4, '"id" >= 3000')
    assert rows(alone) == rows(df.where("id >= 3000")) and alone.rdd.getNumPartitions() == 4


def test_hashed_read_by_every_type(spark):
    df = spark.range(400).select(
        "id",
        (F.col("id") * 4).cast("int").alias("i"),
        (F.col("id") / 7).alias("f"),
        F.col("id").cast("decimal(20,4)").alias("d"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") * 86_401).cast("timestamp_ntz").alias("t"),
        (F.col("id") % 2 == 0).alias("b"),
    )
    options = load(df, "T_HASH_TYPES")
    for column in df.columns:
        got = jdbc.read_jdbc_hashed(spark, options, "T_HASH_TYPES", column, 4)
        assert rows(got) == rows(df), column
        sizes = partition_sizes(got)
        assert column == "b" or (len(sizes) == 4 and sizes[-1] < 2 * sizes[0]), (column, sizes)


@pytest.mark.parametrize("hot", ["5", "NULL"])
def test_balanced_read_cuts_a_hot_key(spark, hot):
    """Nine tenths of the rows on one key, the others far apart."""
    df = spark.range(5000).selectExpr(
        f"CASE WHEN id % 10 > 0 THEN {hot} ELSE id * id END AS k", "id AS v"
    )
    options = load(df, "T_HOT")
    for ties in (None, ["v"]):
        got = jdbc.read_jdbc_balanced(spark, options, "T_HOT", "k", 6, ties)
        assert rows(got) == rows(df)
        sizes = partition_sizes(got)
        assert len(sizes) == 6 and sizes[-1] < 2 * sizes[3]


def test_no_read_of_equal_keys_falls_to_one_connection(spark):
    df = spark.range(900).selectExpr("CAST(NULL AS bigint) AS n", "7L AS same", "id AS v")
    options = load(df, "T_SAME")
    for column in ("n", "same"):
        for read in (jdbc.read_jdbc_partitioned, jdbc.read_jdbc_balanced):
            got = read(spark, options, "T_SAME", column, 3)
            assert rows(got) == rows(df)
            sizes = partition_sizes(got)
            assert len(sizes) == 3 and sizes[-1] < 2 * sizes[1]


def test_balanced_read_by_dates_and_times(spark):
    df = spark.range(1000).selectExpr(
        "date_add(date'2020-01-01', CAST(id * id / 500 AS int)) AS day",
        "timestampadd(SECOND, CAST(id * id AS int), timestamp_ntz'2020-01-01 00:00:00.5') AS t",
        "CAST(id AS string) AS s",
    )
    options = load(df, "T_TIMES")
    for column in ("day", "t"):
        got = jdbc.read_jdbc_balanced(spark, options, "T_TIMES", column, 4)
        assert rows(got) == rows(df)
        sizes = partition_sizes(got)
        assert len(sizes) == 4 and sizes[-1] < 2 * sizes[1]
    with pytest.raises(ValueError, match="read_jdbc_hashed"):
        jdbc.read_jdbc_balanced(spark, options, "T_TIMES", "s", 4)


def test_hash_text_per_database():
    def bucket(kind, **types):
        return dialects.bucket_sql(kind, types, 4)

    assert bucket("mysql", k="string") == "MOD(ABS(7919 * COALESCE(CAST(CRC32(`k`) AS SIGNED), 0)), 4)"
    assert bucket("greenplum", k="long") == (
        'MOD(ABS(7919 * COALESCE(CAST(hashtext(CAST("k" AS text)) AS bigint), 0)), 4)'
    )
    for kind in ("oracle", "dameng"):
        assert bucket(kind, a="string", b="date") == (
            'MOD(ABS(7919 * COALESCE(ORA_HASH("a"), 0) + 104729 * COALESCE(ORA_HASH("b"), 0)), 4)'
        )
    assert bucket("sqlserver", k="string").endswith(" % 4)")
    with pytest.raises(ValueError):
        bucket("mysql")


def test_literals_per_database():
    from datetime import date, datetime
    from decimal import Decimal

    day, time = date(2024, 2, 3), datetime(2024, 2, 3, 4, 5, 6, 70)
    assert dialects.literal("oracle", Decimal("1E+3")) == "1000"
    assert dialects.literal("mysql", -5) == "-5"
    assert dialects.literal("postgresql", day) == "DATE '2024-02-03'"
    assert dialects.literal("derby", day) == "DATE('2024-02-03')"
    assert dialects.literal("oracle", time) == "TIMESTAMP '2024-02-03 04:05:06.000070'"
    assert dialects.literal("sqlserver", time) == "CAST('2024-02-03 04:05:06.000070' AS DATETIME2)"
    for value in ("x", True, None):
        with pytest.raises(ValueError):
            dialects.literal("mysql", value)


def test_staging_text_per_database():
    def like(kind):
        return dialects.empty_like_sql(kind, "t", ["a"], "n", "p")

    assert like("mysql") == "CREATE TABLE n AS SELECT `a`, CAST(0 AS SIGNED) AS `p` FROM t WHERE 1 = 0"
    assert like("oracle") == 'CREATE TABLE n AS SELECT "a", CAST(0 AS NUMBER(19)) AS "p" FROM t WHERE 1 = 0'
    assert like("derby").endswith("WITH NO DATA") and "INTO n FROM t" in like("sqlserver")
    assert dialects.rename_sql("mysql", "s.a", "s.b") == "RENAME TABLE s.a TO s.b"
    assert dialects.rename_sql("derby", "S.A", "S.B") == "RENAME TABLE S.A TO B"
    assert dialects.rename_sql("greenplum", "s.a", "s.b") == "ALTER TABLE s.a RENAME TO b"
    assert dialects.rename_sql("sqlserver", "s.a", "s.b") == "EXEC sp_rename 's.a', 'b'"


@pytest.mark.parametrize(
    "version, old",
    [
        ("PostgreSQL 8.3.23 (Greenplum Database 5.28.6 build ...) on x86_64", True),
        ("PostgreSQL 9.4.26 (Greenplum Database 6.25.3 build ...) on x86_64", True),
        ("PostgreSQL 12.12 (Greenplum Database 7.1.0 build ...) on x86_64", False),
        ("PostgreSQL 9.4.1 on x86_64", True),
        ("PostgreSQL 9.5 on x86_64", False),
        ("PostgreSQL 16.2 (Debian 16.2-1) on x86_64", False),
    ],
)
def test_merge_of_old_members_of_the_family(version, old):
    assert dialects.lacks_on_conflict(version) == old
    sql = dialects.merge_statements("greenplum", "t", "s", ["k", "v"], ["k"], old)
    if old:
        assert [text.split()[0] for text in sql] == ["UPDATE", "INSERT"]
        assert "NOT EXISTS" in sql[1]
        assert len(dialects.merge_statements("greenplum", "t", "s", ["k"], ["k"], True)) == 1
    else:
        assert len(sql) == 1 and "ON CONFLICT" in sql[0]


def test_merge_as_update_and_insert(spark, monkeypatch):
    """The statements for an old database, on the embedded one's syntax for an update."""
    real = unit.merge_statements
    monkeypatch.setattr(unit, "merge_statements", lambda *a: real(*a[:-1], True))
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    options = load(target, "T_OLD", key="k")
    jdbc.merge_jdbc(spark.createDataFrame([(2, "B"), (3, "C")], target.schema), options, "T_OLD", "k")
    assert rows(jdbc.read_jdbc(spark, options, "T_OLD")) == [(1, "a"), (2, "B"), (3, "C")]


def test_whether_a_table_exists(spark):
    options = load(spark.range(1), "T_THERE_IS")
    assert jdbc.table_exists(spark, options, "T_THERE_IS") and jdbc.table_exists(spark, options, "APP.t_there_is")
    assert not jdbc.table_exists(spark, options, "TXTHERE_IS") and not jdbc.table_exists(spark, options, "T_THERE%")
    with pytest.raises(Exception):
        jdbc.table_exists(spark, {**options, "driver": "no.such.Driver"}, "T_THERE_IS")


def test_filter_and_columns_reach_the_database(spark):
    options = load(spark.range(100).withColumn("v", F.col("id")), "T_PUSH")
    plan = jdbc.read_jdbc(spark, options, "T_PUSH").where("id > 90").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(id), *GreaterThan(id,90)]" in text
    assert "ReadSchema: struct<id:bigint>" in text


def test_merge_updates_inserts_and_repeats(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    options = load(target, "T_MERGE", key="k")
    for _ in range(2):
        jdbc.merge_jdbc(updates, options, "T_MERGE", "k")
        assert rows(jdbc.read_jdbc(spark, options, "T_MERGE")) == [(1, "a"), (2, "B"), (3, "C")]


def test_merge_by_two_columns(spark):
    target = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], "k int, l string, v int")
    updates = spark.createDataFrame([(1, "b", 9), (2, "a", 9)], "k int, l string, v int")
    options = load(target, "T_TWO", types={"createTableColumnTypes": "`l` VARCHAR(99)"})
    jdbc.add_unique_key(spark, options, "T_TWO", ["k", "l"])
    jdbc.merge_jdbc(updates, options, "T_TWO", ["k", "l"])
    assert rows(jdbc.read_jdbc(spark, options, "T_TWO")) == [(1, "a", 0), (1, "b", 9), (2, "a", 9)]


def writing_twice(monkeypatch, times=1):
    """The first task of a write commits, is lost, and runs again, ``times`` times over."""
    real, left = unit.write_jdbc, [times]

    def write(frame, options, table, mode="append", partitions=None, **extra):
        real(frame, options, table, mode, partitions, **extra)
        if unit.ROW_POSITION in frame.columns and left[0]:
            left[0] -= 1
            first = frame.where(F.shiftright(unit.ROW_POSITION, unit.PIECE_BITS) == 0)
            real(first, options, table, "append", partitions, **extra)

    monkeypatch.setattr(unit, "write_jdbc", write)
    return left


def test_merge_takes_rows_a_retried_task_wrote_twice(spark, monkeypatch):
    options = load(spark.createDataFrame([(1, "a")], "k int, v string"), "T_TWICE", key="k")
    updates = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    left = writing_twice(monkeypatch)
    jdbc.merge_jdbc(updates, options, "T_TWICE", "k")
    assert rows(jdbc.read_jdbc(spark, options, "T_TWICE")) == [(1, "x"), (2, "y")]
    assert left == [0]


def test_failed_merge_changes_nothing(spark):
    options = load(spark.createDataFrame([(1, "a")], "k int, v string"), "T_FAIL", key="k")
    updates = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception):
        jdbc.merge_jdbc(updates, options, "T_FAIL", "k")
    assert rows(jdbc.read_jdbc(spark, options, "T_FAIL")) == [(1, "a")]


@pytest.mark.parametrize("times", [1, 3])
def test_append_keeps_equal_rows_but_not_those_of_a_retry(spark, monkeypatch, times):
    options = load(spark.range(0), "T_APPEND")
    df = spark.range(60).repartition(4).select((F.col("id") % 2).alias("id"))
    jdbc.append_jdbc(df, options, "T_APPEND")
    left = writing_twice(monkeypatch, times)
    jdbc.append_jdbc(df, options, "T_APPEND", isolation="SERIALIZABLE")
    assert rows(jdbc.read_jdbc(spark, options, "T_APPEND")) == [(0,)] * 60 + [(1,)] * 60
    assert left == [0]


def test_append_of_null_and_long_texts_in_any_order(spark, sf_dir, monkeypatch):
    customers = dirty_customer(spark, sf_dir).withColumn("long", F.expr("repeat(name, 2000)"))
    mixed = customers.unionByName(customers).repartition(5, F.rand())
    options = database(spark)
    jdbc.drop_table(spark, options, "T_DIRTY")
    writing_twice(monkeypatch)
    jdbc.append_jdbc(mixed, options, "T_DIRTY", partitions=3)
    back = jdbc.read_jdbc_hashed(spark, options, "T_DIRTY", ["id"], 3)
    assert back.exceptAll(mixed).isEmpty() and mixed.exceptAll(back).isEmpty()


def test_writer_that_is_late_reaches_nothing(spark, monkeypatch):
    """A lost task that goes on after its table was renamed fails; the append stands."""
    options = load(spark.range(0), "T_LATE")
    real, names = unit.DatabaseUnit._fenced, []

    def fenced(self, name):
        new = real(self, name)
        names.append(name)
        late = spark.range(3).withColumn(unit.ROW_POSITION, F.col("id"))
        with pytest.raises(Exception):
            jdbc.execute(spark, options, [f"INSERT INTO {name} VALUES (1, 1)"])
        return new

    monkeypatch.setattr(unit.DatabaseUnit, "_fenced", fenced)
    jdbc.append_jdbc(spark.range(5), options, "T_LATE")
    assert rows(jdbc.read_jdbc(spark, options, "T_LATE")) == [(i,) for i in range(5)]
    assert names


def test_unit_changes_all_tables_or_none(spark):
    options = load(spark.range(2), "T_UNIT_A")
    load(spark.createDataFrame([(1, 0)], "k int, v int"), "T_UNIT_B", key="k")
    more, conflict = spark.range(2, 5), spark.createDataFrame([(2, 1), (2, 2)], "k int, v int")
    with pytest.raises(Exception), jdbc.DatabaseUnit(spark, options) as changes:
        changes.append(more, "T_UNIT_A")
        changes.merge(conflict, "T_UNIT_B", "k")
        changes.commit()
    assert rows(jdbc.read_jdbc(spark, options, "T_UNIT_A")) == [(0,), (1,)]
    with jdbc.DatabaseUnit(spark, options) as changes:
        changes.append(more, "T_UNIT_A")
        changes.merge(conflict.where("v = 2"), "T_UNIT_B", "k")
    assert jdbc.read_jdbc(spark, options, "T_UNIT_A").count() == 2  # never committed
    with jdbc.DatabaseUnit(spark, options, "SERIALIZABLE") as changes:
        changes.append(more, "T_UNIT_A")
        changes.merge(conflict.where("v = 2"), "T_UNIT_B", "k")
        changes.commit()
    assert jdbc.read_jdbc(spark, options, "T_UNIT_A").count() == 5
    assert rows(jdbc.read_jdbc(spark, options, "T_UNIT_B")) == [(1, 0), (2, 2)]


def test_append_makes_a_missing_table(spark):
    options = database(spark)
    jdbc.drop_table(spark, options, "T_NEW")
    jdbc.append_jdbc(spark.range(3), options, "T_NEW")
    assert jdbc.read_jdbc(spark, options, "T_NEW").count() == 3


def test_append_once_keeps_old_rows(spark):
    options = load(spark.createDataFrame([(1, "a")], "k int, v string"), "T_ONCE", key="k")
    new = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    for _ in range(2):
        jdbc.append_once_jdbc(new, options, "T_ONCE", "k")
        assert rows(jdbc.read_jdbc(spark, options, "T_ONCE")) == [(1, "a"), (2, "y")]


def test_staging_tables_are_dropped(spark):
    before = database(spark)
    options = load(spark.range(3), "T_STAGE", key="id")
    jdbc.merge_jdbc(spark.range(5), options, "T_STAGE", "id")
    left = jdbc.read_jdbc_query(spark, before, "SELECT tablename FROM sys.systables WHERE tablename LIKE 'TC\\_%' ESCAPE '\\'")
    assert left.count() == 0


def test_tables_by_kind(spark):
    options = load(spark.range(9), "T_KIND")
    assert tables.read_table(spark, "derby", "", "T_KIND", options).count() == 9
    assert tables.read_table(spark, "derby", "", "T_KIND", options, "id", 3).rdd.getNumPartitions() == 3
    tables.write_table(spark.range(9, 12), "derby", "", "T_KIND", "append", options)
    assert tables.read_table(spark, "derby", "", "T_KIND", options).count() == 12
    jdbc.add_unique_key(spark, options, "T_KIND", "id")
    tables.write_table(spark.range(20), "derby", "", "T_KIND", "update", options, "id")
    assert tables.read_table(spark, "derby", "", "T_KIND", options).count() == 20
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    tables.write_table(spark.range(4), "HIVE2", "shop", "items", "overwrite")
    assert tables.read_table(spark, "hive", "shop", "items").count() == 4
    assert "shop" in [r[0] for r in files.list_databases(spark).collect()]
    with pytest.raises(ValueError):
        tables.read_table(spark, "hbase", "", "T")
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), "hive", "shop", "items", "update", key="id")


# Files and views


def test_update_statements():
    def update(kind):
        return dialects.update_sql(kind, "t", "s", ["k", "v", "w"], ["k"])

    assert update("mysql") == "UPDATE t t JOIN s s ON t.`k` = s.`k` SET t.`v` = s.`v`, t.`w` = s.`w`"
    sets = '"v" = s."v", "w" = s."w"'
    for kind in ("postgresql", "greenplum"):
        assert update(kind) == f'UPDATE t AS t SET {sets} FROM s AS s WHERE t."k" = s."k"'
    for kind in ("oracle", "dameng", "derby"):
        merge = f'MERGE INTO t t USING s s ON (t."k" = s."k") WHEN MATCHED THEN UPDATE SET {sets}'
        assert update(kind) == merge
    with pytest.raises(ValueError, match="besides the key"):
        dialects.update_sql("mysql", "t", "s", ["k"], ["k"])


def test_update_brings_no_deleted_row_back(spark):
    table = spark.createDataFrame([(1, 10, 5), (2, 20, 5)], "k int, v int, w int")
    options = load(table, "T_UPDATE", types={}, key="k")
    updates = spark.createDataFrame([(2, 21), (3, 31)], "k int, v int")
    jdbc.update_jdbc(updates, options, "T_UPDATE", "k")
    assert rows(jdbc.read_jdbc(spark, options, "T_UPDATE")) == [(1, 10, 5), (2, 21, 5)]


def test_csv_keeps_null_apart_when_asked(spark, tmp_path):
    hard = ["a b", 'q"', "l1\nl2", "\r", "\r\n x", " lead", "trail ", "\\", "\\n", "\\\\n", "\\N", "\\-", "NULL"]
    hard += ["\\\n\\", '"', "a,b", "-", "\t"]
    df = spark.createDataFrame([(1, None), (2, ""), *enumerate(hard, 3)], "i int, x string")
    for number, null_text in enumerate((None, "\\N", "NULL", "-")):
        path = str(tmp_path / str(number))
        files.write_csv(df, path, null_text=null_text)
        back = files.read_csv(spark, path, df.schema, null_text=null_text)
        empty = None if null_text is None else ""
        assert dict(rows(back)) == {1: None, 2: empty, **dict(enumerate(hard, 3))}
        assert spark.read.text(path).count() >= df.count()


def test_sorted_export_splits_a_hot_value(spark, tmp_path):
    df = spark.range(20_000).select(F.lit("2018-09-01").alias("d"), "id").repartition(8)
    path = str(tmp_path / "sorted")
    ordered = files.sort_for_export(df, "d", ["id"])
    files.write_csv(ordered, path)
    back = files.read_csv(spark, path, df.schema)
    ids = [r.id for r in ordered.collect()]
    assert ids == list(range(20_000))
    assert rows(back) == rows(df)
    sizes = [r["count"] for r in df.repartitionByRange(8, "d", "id").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 5_000


def test_global_view_replaces_a_stale_one(spark):
    spark.range(1).createOrReplaceGlobalTempView("tc_view")
    with files.global_view(spark.range(5), "tc_view") as name:
        assert spark.table(name).count() == 5
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.table("global_temp.tc_view").count()


def test_rows_since_is_inclusive(spark):
    df = spark.sql("SELECT timestamp_ntz '2018-09-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz '2018-08-31 23:59:59'")
    assert files.rows_since(df, "t", "2018-09-01").count() == 1


def test_generic_source(spark, sf_dir):
    got = files.read_source(spark, "parquet", {"mergeSchema": "false"}, f"{sf_dir}/region.parquet")
    assert got.count() == 5
    path = f"{sf_dir}/region.parquet"
    assert files.read_source(spark, "parquet", path=path, schema="r_name string").columns == ["r_name"]


def lines_of(spark, path, schema, size):
    jsonlines.register(spark)
    return files.read_source(spark, jsonlines.NAME, {"partitionBytes": str(size)}, path, schema)


@pytest.mark.parametrize("size", [1, 7, 100, 1000, 10**6])
def test_own_source_reads_every_line_once(spark, tmp_path, monkeypatch, size):
    """Whatever bytes the partitions end at, with blank lines and no last line feed."""
    lines = [json.dumps({"k": i, "t": "é" * (i % 40) + "x"}, ensure_ascii=False) for i in range(60)]
    text = "\n\n".join(lines) + "\r\n" + json.dumps({"k": 60, "t": None, "more": 1})
    path = tmp_path / "some.json"
    path.write_bytes(text.encode())
    # read as the tasks do, with small blocks too
    schema = T.StructType.fromDDL("k long, t string")
    for block in (3, 50, jsonlines.BLOCK_BYTES):
        monkeypatch.setattr(jsonlines, "BLOCK_BYTES", block)
        reader = jsonlines.JsonLinesReader(schema, {"path": str(path), "partitionbytes": str(size)})
        got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        expected = [{"k": i, "t": "é" * (i % 40) + "x"} for i in range(60)] + [{"k": 60, "t": None}]
        assert sorted(got, key=lambda r: r["k"]) == expected


def test_own_source_in_partitions_with_pushed_filters(spark, sf_dir, tmp_path):
    path = str(tmp_path / "orders")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.write.json(path)
    got = lines_of(spark, path, orders.schema, 2**18)
    assert got.rdd.getNumPartitions() >= 4
    assert rows(got) == rows(orders)
    chosen = got.where("o_orderstatus = 'F' AND o_custkey > 700 AND o_orderkey % 7 = 1")
    text = chosen._jdf.queryExecution().executedPlan().toString()
    left = next(line for line in text.splitlines() if "Filter" in line)
    assert "o_orderkey" in left and "o_custkey" not in left and "o_orderstatus" not in left
    same = orders.where("o_orderstatus = 'F' AND o_custkey > 700 AND o_orderkey % 7 = 1")
    assert rows(chosen) == rows(same)


@pytest.mark.parametrize(
    "where",
    [
        "t = 'b'", "t <> 'b'", "t IS NULL", "t IS NOT NULL", "t <=> 'b'", "NOT (t <=> 'b')",
        "t <=> NULL", "t IN ('a', 'b')", "t NOT IN ('a', 'b')", "t LIKE 'a%'", "k > 2", "k >= 2",
        "k < 2", "k <= 2", "NOT k > 2", "k IN (1, NULL)", "f > 1.5", "f = double('NaN')",
        "k = 1 OR t = 'b'", "d >= date'2024-01-02'", "n.x = 1",
    ],
)
def test_own_source_filters_like_spark(spark, tmp_path, where):
    data = spark.sql(
        "SELECT * FROM VALUES (1, 'a', 1.0D, date'2024-01-01'), (2, 'b', 2.0D, date'2024-01-02'), "
        "(3, NULL, NULL, NULL), (NULL, 'ab', 3.5D, date'2024-01-03') AS v(k, t, f, d)"
    ).selectExpr("*", "named_struct('x', k) AS n")
    path = str(tmp_path / "v")
    data.coalesce(1).write.json(path)
    got = lines_of(spark, path, data.schema, 10**6)
    assert rows(got.where(where)) == rows(data.where(where))


def test_own_source_needs_a_path(spark):
    jsonlines.register(spark)
    with pytest.raises(Exception, match="needs a path"):
        spark.read.format(jsonlines.NAME).schema("k long").load().collect()


def test_catalogue_table_is_pruned(spark, sf_dir):
    """One filter skips partitions when the query is planned, a join while it runs."""
    from workload.queries import QUERIES

    found = QUERIES["metastore_scan"](spark, sf_dir)
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet spark_catalog.tablecheck_shop.orders_by_year" in text
    scan = next(line for line in text.splitlines() if "tablecheck_shop.orders_by_year" in line)
    assert "(o_year#" in scan and ">= 1993)" in scan and "dynamicpruningexpression" in scan


def test_table_by_text_key_is_read_in_parallel(spark):
    df = spark.range(400).selectExpr("'key ' || id AS k", "id")
    options = load(df, "T_TEXT_KEY", types={})
    got = tables.read_table(spark, "derby", "", "T_TEXT_KEY", options, "k", 3)
    assert rows(got) == rows(df) and got.rdd.getNumPartitions() == 3


# Session


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = {k.replace("_", "."): v for k, v in values.items()}

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_scratch_folder(spark):
    shared = spark.conf.get(session.CHECKPOINT_DIR)
    assert session.scratch_path(spark, "x").startswith(shared)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    assert session.scratch_root(Settings(spark_master="local[4]")).startswith("/")
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.scratch_root(Settings(spark_master=master))
        with pytest.raises(RuntimeError):
            database(Settings(spark_master=master))


def test_drop_scratch_takes_scratch_only(spark):
    path = session.scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    session.drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/tmp")
