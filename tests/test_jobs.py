from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablecheck import Rule
from tablecheck.functions import predicates as P
from tablecheck.operators import checks
from tablecheck.operators.upsert import upsert_by_key
from tablecheck.plans import jobs
from tablecheck.sources import files, jdbc
from workload.database import database, load
from workload.tables import stateful_orders

TIME = "2024-06-01 12:00:00"


def run_regex_job(df, sinks, key="o_orderkey"):
    rule = Rule("checked", regex="^[12]-", message="bad")
    return jobs.regex_check_job(
        df, rule, key, job_id="j", task_name="t", check_time=TIME, sinks=sinks
    )


def test_regex_job_fills_every_sink(spark, sf_dir):
    got = {}

    def sink(name):
        return lambda df: got.update({name: df.collect()})

    orders = stateful_orders(spark, sf_dir)
    names = ("marks", "macro", "detail", "result")
    counts = run_regex_job(orders, jobs.CheckSinks(**{n: sink(n) for n in names}))
    blank = orders.where("checked = ''").count()
    assert len(got["marks"]) == counts.illegal_strict + blank
    assert [r["Count"] for r in got["macro"]] == [counts.illegal, counts.legal, counts.null_or_empty]
    assert len(got["detail"]) == 100
    [result] = got["result"]
    assert (result.spark_job_id, result.score) == ("j", counts.score)
    assert f'"total":{counts.total}' in result.result


def test_regex_job_without_sinks_or_key(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir)
    assert run_regex_job(orders, jobs.CheckSinks()).total == 15_000
    with pytest.raises(ValueError):
        run_regex_job(orders, jobs.CheckSinks(), key=" ")


def test_counts_are_collected_while_the_marks_are_written(spark, sf_dir, tmp_path):
    """Two reads of the source: marks with counts, and the sample."""
    orders = stateful_orders(spark, sf_dir)
    folder, tracker = str(tmp_path), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("regex job", "")
    names = ("marks", "macro", "detail", "result")
    sinks = {n: (lambda df, n=n: df.write.parquet(f"{folder}/{n}")) for n in names}
    counts = run_regex_job(orders, jobs.CheckSinks(**sinks))
    spark.sparkContext.setJobGroup("other", "")
    store = spark._jsc.sc().statusStore()
    rows = []
    for job in tracker.getJobIdsForGroup("regex job"):
        for stage in tracker.getJobInfo(job).stageIds:
            rows.append(store.lastStageAttempt(stage).inputRecords())
    assert sorted(r for r in rows if r >= 15_000) == [15_000, 15_000]
    assert counts == checks.regex_check(orders, "checked", "^[12]-").first()


@pytest.mark.parametrize("mode", ["find", "full"])
def test_counts_of_the_job_are_those_of_the_check(spark, sf_dir, mode):
    orders = stateful_orders(spark, sf_dir).repartition(3)
    rule = Rule("checked", regex="[12]-.*|", mode=mode, message="bad")
    for source in (orders, orders.limit(0)):
        got = []
        counts = jobs.regex_check_job(
            source, rule, "checked", job_id="j", task_name="t", check_time=TIME,
            sinks=jobs.CheckSinks(marks=lambda df: got.extend(df.collect())),
        )
        check = checks.regex_check(source, "checked", rule.regex, mode=mode).first()
        assert counts == check and len(got) == check.illegal_strict


def database_job(spark, orders, tables, mode="find"):
    options = database(spark)
    rule = Rule("checked", regex="^[12]-.*", mode=mode, message="bad")
    counts = jobs.regex_check_to_database(
        orders, rule, "o_orderkey", options, "T_SOURCE", tables,
        job_id="j", task_name="t", check_time=TIME,
    )
    return counts


def test_database_results_arrive_together(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir)
    options = database(spark)
    for name in ("CHK_T_SOURCE", "T_MACRO", "T_DETAIL"):
        jdbc.drop_table(spark, options, name)
    load(spark.createDataFrame([("old", "{}", 1.0)], RESULT), "T_RESULT", key="spark_job_id")
    tables = jobs.ResultTables(macro="T_MACRO", detail="T_DETAIL", result="T_RESULT")
    sizes = lambda: [jdbc.read_jdbc(spark, options, n).count() for n in NAMES]
    counts = database_job(spark, orders, tables)
    marks = counts.illegal_strict + orders.where("checked = ''").count()
    assert sizes() == [marks, 3, 100, 2]
    database_job(spark, orders, tables)
    assert sizes() == [2 * marks, 6, 200, 2]
    # a third target that refuses its rows: no target changes
    limit = "ALTER TABLE T_DETAIL ADD CONSTRAINT FULL_TABLE CHECK (LENGTH(\"jobId\") > 1)"
    jdbc.execute(spark, options, ["DELETE FROM T_DETAIL", limit])
    with pytest.raises(Exception, match="FULL_TABLE"):
        database_job(spark, orders, tables, "full")
    assert sizes() == [2 * marks, 6, 0, 2]


def test_marks_go_to_the_named_table(spark, sf_dir):
    options = database(spark)
    jdbc.drop_table(spark, options, "T_MY_MARKS")
    orders = stateful_orders(spark, sf_dir)
    database_job(spark, orders, jobs.ResultTables(marks="T_MY_MARKS"))
    assert jdbc.read_jdbc(spark, options, "T_MY_MARKS").count() > 0


RESULT = "spark_job_id string, result string, score double"
NAMES = ("CHK_T_SOURCE", "T_MACRO", "T_DETAIL", "T_RESULT")


def test_state_job_on_files_can_be_repeated(spark, sf_dir, tmp_path):
    orders = stateful_orders(spark, sf_dir).select("o_orderkey", "checked", "jcsjc")
    counts = []
    table = orders
    for run in range(2):
        path = str(tmp_path / f"run{run}")

        def merge(updates, table=table, path=path):
            upsert_by_key(table, updates, "o_orderkey").write.parquet(path)

        row = jobs.state_check_job(table, P.not_null("checked"), check_time=TIME, merge=merge)
        counts.append((row.total, row.legal, row.illegal, row.score))
        if run == 0:
            table = spark.read.parquet(path)
    assert counts == [(3750, 3000, 750, 80.0), (0, 0, 0, None)]
    assert table.count() == 15_000


def test_blank_state_job_stamps_legal_rows_only(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir).select("o_orderkey", "checked", "jcsjc")
    seen = []
    row = jobs.state_check_job(
        orders,
        P.not_blank("checked"),
        check_time=TIME,
        form="null",
        stamp_illegal=False,
        merge=lambda updates: seen.extend(updates.collect()),
    )
    assert row.total == 3750 and row.legal + row.illegal == 3750
    assert len(seen) == row.legal
    assert {str(r.jcsjc) for r in seen} == {TIME}


def test_state_job_in_the_database(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir).select("o_orderkey", "checked", "jcsjc")
    options = load(orders, "T_STATE_JOB", types={}, key="o_orderkey")

    def run():
        return jobs.state_check_job(
            jdbc.read_jdbc_partitioned(spark, options, "T_STATE_JOB", "o_orderkey", 4),
            P.not_null("checked"),
            check_time=TIME,
            keep=["o_orderkey"],
            merge=lambda u: jdbc.merge_jdbc(u, options, "T_STATE_JOB", "o_orderkey"),
        )

    assert tuple(run()) == (3750, 3000, 750, 80.0)
    assert run().total == 0
    states = jdbc.read_jdbc(spark, options, "T_STATE_JOB").groupBy("jcsjc").count().collect()
    assert {str(r.jcsjc): r["count"] for r in states} == {
        "None": 3750, "2024-01-01 00:00:00": 3750, TIME: 3000, "2200-01-01 00:00:00": 4500
    }


def test_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "Ann", "13812345678", "2018-09-01"), (2, "Bob", None, "2018-08-31")],
        "id int, name string, phone string, ldsjc string",
    )
    entries = [
        jobs.ExportEntry("plain", df),
        jobs.ExportEntry("masked", df, masks={"name": "name", "phone": "phone"}),
        jobs.ExportEntry("sql", df, select="SELECT id, phone_rm_sensitive(phone) AS phone FROM sourceData"),
    ]
    paths = jobs.export_job(entries, str(tmp_path), since=("ldsjc", "2018-09-01"))
    assert list(paths) == ["plain", "masked", "sql"]
    read = lambda name, schema: [tuple(r) for r in files.read_csv(spark, paths[name], schema).collect()]
    assert read("plain", df.schema) == [(1, "Ann", "13812345678", "2018-09-01")]
    assert read("masked", df.schema) == [(1, "A**", "138****5678", "2018-09-01")]
    assert read("sql", "id int, phone string") == [(1, "138****5678")]


def test_copy(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    options = load(df.limit(0), "T_COPY", key="id")
    for _ in range(2):
        jobs.copy_job(df, options, "T_COPY", key="id", partitions=2)
    assert jdbc.read_jdbc(spark, options, "T_COPY").count() == 10
    for mode, rows in (("overwrite", 10), ("append", 20), ("overwrite", 10)):
        jobs.copy_job(df, options, "T_COPY2", mode=mode)
        assert jdbc.read_jdbc(spark, options, "T_COPY2").count() == rows
    with pytest.raises(ValueError):
        jobs.copy_job(df, options, "T_COPY2", mode="ignore")
