from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablecheck import Rule, rules_from_json
from tablecheck.functions import predicates as P
from tablecheck.operators import catalog, checks, marks, numbering, regression, state
from tablecheck.operators.upsert import upsert_by_key, upsert_partitions
from tablecheck.rules import unquote
from workload.tables import stateful_orders

TIME = "2024-06-01 12:00:00"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Checks


def test_regex_check_counts_empty_twice(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("b",), ("",), ("c",)], "x string")
    row = checks.regex_check(df, "x", ".*").first()
    assert (row.total, row.legal, row.null_or_empty, row.illegal) == (6, 5, 3, -2)
    assert row.illegal_strict == 0


def test_checks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x string")
    assert tuple(checks.null_check(df, "x").first()) == (0, 0, 0, None)
    assert tuple(checks.blank_check(df, "x").first()) == (0, 0, 0, None)
    assert tuple(checks.regex_check(df, "x", "a").first()) == (0, 0, 0, 0, 0, None)
    assert [r["percent"] for r in checks.macro_summary(checks.regex_check(df, "x", "a"), "t", "j", TIME).collect()] == [None] * 3


def test_blank_check_counts_null_as_illegal_but_has_it_in_no_set(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "x string")
    assert tuple(checks.blank_check(df, "x").first())[:3] == (3, 1, 2)
    legal, illegal = state.split_rows(df, P.not_blank("x"))
    assert (rows(legal), rows(illegal)) == ([("a",)], [("",)])


def test_many_rules_equal_single_passes(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir)
    rules = [Rule("checked", regex=r, name=r) for r in ("^1", "LOW$", ".*", "x")]
    together = {r["rule"]: tuple(r)[2:] for r in checks.multi_rule_check(orders, rules).collect()}
    for rule in rules:
        assert together[rule.label] == tuple(checks.regex_check(orders, "checked", rule.regex).first())


def test_groups_add_up(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir)
    whole = checks.regex_check(orders, "checked", "^1").first()
    parts = checks.regex_check(orders, "checked", "^1", by=["o_orderstatus"]).collect()
    for name in ("total", "legal", "null_or_empty", "illegal", "illegal_strict"):
        assert sum(p[name] for p in parts) == whole[name]


def test_rules_are_checked():
    for wrong in (
        {"column": "x"},
        {"column": "x", "kind": "null", "regex": "a"},
        {"column": "x", "kind": "other"},
        {"column": "x", "regex": "a", "mode": "any"},
    ):
        with pytest.raises(ValueError):
            Rule(**wrong)


def test_rule_names_must_differ(spark):
    with pytest.raises(ValueError):
        checks.multi_rule_check(spark.range(1), [Rule("id", "null"), Rule("id", "null")])
    with pytest.raises(ValueError):
        checks.multi_rule_check(spark.range(1), [])


def test_rule_template():
    [rule] = rules_from_json(
        """{"name": "n", "params": [
            {"seq": 2, "key": "regex", "example": "^9", "value": "^1[36]$"},
            {"seq": 1, "key": "columnName", "example": "other", "value": "'c'"}]}"""
    )
    assert rule == Rule("c", regex="^1[36]$", name="n")
    column = '{"key": "columnName", "example": "d", "value": "c"}'
    assert rules_from_json(f'[{{"params": [{column}]}}]') == [Rule("c", "null")]
    assert rules_from_json(f'{{"prototype": "blank", "params": [{column}]}}') == [Rule("c", "blank")]
    for missing in ('{"key": "columnName", "example": "d"}', f'{column}, {{"key": "regex", "example": "^9"}}'):
        with pytest.raises(ValueError, match="no value"):
            rules_from_json(f'{{"name": "n", "params": [{missing}]}}')
    assert [unquote(t) for t in ("'a'", "'a", "a", "''", "'")] == ["a", "'a", "a", "", "'"]


# Marks


def test_marks_skip_null_and_hold_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "b")], "k int, x string")
    got = marks.invalid_marks(df, "k", "x", r"\Aa\z", "bad", TIME)
    assert rows(got) == [("2", "bad", "x", TIME), ("4", "bad", "x", TIME)]


def test_marks_follow_the_mode(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abX"), (3, "zz"), (4, ""), (5, None)], "k int, v string")
    for mode, marked in (("find", ["3", "4"]), ("full", ["2", "3", "4"])):
        row = checks.regex_check(df, "v", "ab", mode=mode).first()
        got = marks.invalid_marks(df, "k", "v", "ab", "", TIME, mode)
        assert sorted(x.SOURCE_TABLE_PK for x in got.collect()) == marked
        assert len(marked) == row.illegal_strict + 1


def test_sample_of_a_clustered_table(spark):
    df = spark.range(500).selectExpr("id AS k", "if(id % 3 = 0, 'x', 'ok') AS v")
    plain, clustered = (marks.illegal_sample(df, "v", "ok", "k", clustered=c) for c in (False, True))
    assert plain.collect() == clustered.collect() and plain.count() == 100


def test_marks_agree_with_the_count(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir)
    row = checks.regex_check(orders, "checked", "^[12]-").first()
    marked = marks.invalid_marks(orders, "o_orderkey", "checked", "^[12]-", "", TIME).count()
    blank = orders.where("checked = ''").count()
    assert marked == row.illegal_strict + blank


def test_sample_reads_null_as_text(spark):
    data = [(i, v) for i, v in enumerate(["a", "ab", None, "", "b"])]
    df = spark.createDataFrame(data, "k int, x string")
    assert [r.k for r in marks.illegal_sample(df, "x", "a", "k").collect()] == [1, 2, 3, 4]
    assert [r.k for r in marks.illegal_sample(df, "x", "a|null", "k", n=2).collect()] == [1, 3]
    detail = marks.detail_rows(marks.illegal_sample(df, "x", "a", "k", n=2), "j").collect()
    assert [r.illgeadata for r in detail] == ['{"k":"1","x":"ab"}', '{"k":"2","x":" "}']


def test_sample_equals_a_full_sort(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, *range(30)]), i, rng.choice(["a", "b", None])) for i in range(500)]
    df = spark.createDataFrame(data, "k int, i int, x string").repartition(5)
    illegal = marks.illegal_rows(df, "x", "a")
    for n in (1, 7, 40, 1000):
        expected = illegal.orderBy("k", "i").collect()[:n]
        assert marks.illegal_sample(df, "x", "a", ["k", "i"], n).collect() == expected
    assert marks.illegal_sample(df, "x", "a|b|null", "k").collect() == []


# State


@pytest.mark.parametrize("form, stamp_illegal", [("sentinel", True), ("null", True), ("null", False)])
@pytest.mark.parametrize("legal", [P.not_null, P.not_blank])
def test_single_pass_equals_keyed_merge(spark, sf_dir, form, stamp_illegal, legal):
    orders = stateful_orders(spark, sf_dir).select("o_orderkey", "checked", "jcsjc")
    options = {"form": form, "stamp_illegal": stamp_illegal}
    updates = state.state_updates(orders, legal("checked"), TIME, **options)
    merged = upsert_by_key(orders, updates, "o_orderkey")
    single = state.check_with_state(orders, legal("checked"), TIME, **options)
    assert rows(merged) == rows(single)
    assert rows(upsert_by_key(merged, updates, "o_orderkey")) == rows(single)


def test_a_second_check_finds_nothing_pending(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir)
    checked = state.check_with_state(orders, P.not_null("checked"), TIME)
    assert state.pending_rows(checked, "sentinel").count() == 0


def test_unknown_pending_form(spark, sf_dir):
    with pytest.raises(ValueError):
        state.pending_rows(stateful_orders(spark, sf_dir), "other")


def test_upsert_with_hot_and_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "k int, v string")
    updates = spark.createDataFrame([(1, "new"), (3, "add")], "k int, v string")
    assert rows(upsert_by_key(target, updates, "k")) == rows(
        spark.createDataFrame([(1, "new"), (3, "add"), (None, "n"), (2, "c")], "k int, v string")
    )


def test_upsert_by_two_columns(spark):
    target = spark.createDataFrame([(1, "a", 0), (1, "b", 0), (2, "a", 0)], "k int, l string, v int")
    updates = spark.createDataFrame([("b", 1, 9), ("c", 1, 9)], "l string, k int, v int")
    got = upsert_by_key(target, updates, ["k", "l"])
    assert got.columns == target.columns
    assert rows(got) == [(1, "a", 0), (1, "b", 9), (1, "c", 9), (2, "a", 0)]


# Numbering


def global_numbers(df, *order):
    return df.withColumn("rownum", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


@pytest.mark.parametrize("partitions", [None, 1, 10, 137])
def test_numbers_equal_the_global_window(spark, partitions):
    df = spark.range(3000).select(
        ((F.col("id") * 7919) % 3001).alias("k"), (F.col("id") % 3).alias("v")
    )
    got = numbering.number_rows(df, "k", partitions=partitions)
    assert rows(got) == rows(global_numbers(df, "k"))


def test_numbers_of_ties_nulls_and_text(spark):
    rng = random.Random(5)
    words = [None, "", "a", "b", "é", "zz", 'q"uote', "back\\slash"]
    data = [(rng.choice(words), rng.choice([None, 1.5, -2.0, float("nan")]), i) for i in range(2000)]
    df = spark.createDataFrame(data, "w string, x double, i int")
    got = numbering.number_rows(df, ["w", "x"], partitions=40)
    order = got.orderBy("rownum").collect()
    assert [r.rownum for r in order] == list(range(1, 2001))
    assert sorted(r.i for r in order) == list(range(2000))
    expected = [tuple(r) for r in df.orderBy("w", "x").select("w", "x").collect()]
    assert repr([(r.w, r.x) for r in order]) == repr(expected)


def test_numbers_of_timestamps(spark):
    df = spark.range(500).select(
        (F.timestamp_seconds(1_700_000_000 + (F.col("id") * 37) % 500)
         + F.expr("make_interval(0,0,0,0,0,0,0.000123)")).alias("t"),
        "id",
    )
    got = numbering.number_rows(df, "t", partitions=25)
    assert rows(got) == rows(global_numbers(df, "t"))


@pytest.mark.parametrize("share", [3, 1])
def test_numbers_of_copies(spark, share):
    """A third of all rows, or all rows, are copies of one row; partitions stay even."""
    df = spark.range(3000).select(
        F.when(F.col("id") % share == 0, 500).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    )
    got = numbering.number_rows(df, "k", partitions=12)
    assert rows(got) == rows(global_numbers(df, "k"))
    parts = df.withColumn("t", F.rand(numbering.TIE_SEED)).repartitionByRange(12, "k", "t")
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 3000 / 12


def test_numbers_of_rows_that_hold_a_map(spark):
    df = spark.range(30).selectExpr("id % 4 AS k", "map('a', id) AS m")
    got = numbering.number_rows(df, "k", partitions=3).orderBy("rownum").collect()
    assert [r.rownum for r in got] == list(range(1, 31))
    assert [r.k for r in got] == sorted(r.k for r in got)
    assert sorted(r.m["a"] for r in got) == list(range(30))


def test_numbers_of_an_empty_table(spark):
    got = numbering.number_rows(spark.range(0), "id")
    assert got.columns == ["id", "rownum"] and got.count() == 0


def test_numbering_refuses_taken_names(spark):
    for taken in ("rownum", "_tie", "_place"):
        with pytest.raises(ValueError):
            numbering.number_rows(spark.range(3).withColumn(taken, F.lit(1)), "id")


def test_bounds(spark):
    assert tuple(numbering.partition_bounds(spark.range(3, 9), "id").first()) == (3, 8, 6)


# Catalogue


RESOURCES = "id int, name string"
NAMES = {"id": "id", "name": "shownName"}


def test_catalogue(spark):
    resources = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], RESOURCES)
    mapper = spark.createDataFrame(
        [(1, 10), (1, 20), (3, 20), (3, 20), (None, 20)], "catalog_id int, classify_id int"
    )
    assert rows(catalog.resource_of_class(resources, mapper, 10, NAMES)) == [(1, "a")]
    assert rows(catalog.resource_of_class(resources, mapper, 99, NAMES)) == []
    assert rows(catalog.resources_of_class(resources, mapper, 20, NAMES)) == [(1, "a"), (3, "c")]
    assert catalog.list_resources(resources, NAMES).columns == ["id", "shownName"]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        catalog.resource_of_class(resources, mapper, 20, NAMES).collect()


# Regression


def test_split_is_repeatable_and_whole(spark):
    df = spark.range(20_000)
    train, test = regression.split_by_key(df, "id")
    again, _ = regression.split_by_key(df.repartition(7), "id")
    assert train.count() + test.count() == 20_000
    assert train.exceptAll(again).count() == 0
    assert 0.89 < train.count() / 20_000 < 0.91
    other, _ = regression.split_by_key(df, "id", seed=1)
    assert train.exceptAll(other).count() > 0


def test_tuned_fit_tries_the_grid(spark):
    df = spark.range(400).select(
        F.col("id").cast("double").alias("x"), (F.col("id") * 3 + 5 + F.col("id") % 7).alias("y")
    )
    data = regression.with_features(df, ["x"], "y").select("features", "label")
    model = regression.fit_tuned(data)
    assert len(model.validationMetrics) == 12
    best = min(model.validationMetrics)
    assert best < 3
    scored = regression.score(model, data)
    assert scored.columns == ["features", "label", "prediction"]
    plain = regression.fit_linear(data)
    assert abs(plain.coefficients[0] - 3) < 0.01


def file_times(path):
    return {
        str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")
    }


def test_partitioned_upsert_leaves_other_files_alone(spark, tmp_path):
    schema = "k long, v string, p string"
    rows = [(i, "old", f"p{i % 5}/é") for i in range(50)] + [(99, "null", None)]
    path = tmp_path / "table"
    spark.createDataFrame(rows, schema).write.partitionBy("p").parquet(str(path))
    before = file_times(path)
    updates = [(0, "new", "p0/é"), (5, "moved", "fresh"), (100, "added", "p1/é"), (7, None, "p2/é")]
    given = spark.createDataFrame(updates, schema)
    touched = upsert_partitions(spark, str(path), given, "k", "p")
    assert sorted(touched) == ["fresh", "p0/é", "p1/é", "p2/é"]
    after = file_times(path)
    same = [n for n in before if "p3" in n or "p4" in n or "__HIVE" in n]
    assert len(same) >= 3 and all(after[n] == before[n] for n in same)
    back = spark.read.schema(schema).parquet(str(path))
    expected = {r[0]: r for r in rows} | {r[0]: r for r in updates}
    assert {r.k: tuple(r) for r in back.collect()} == expected and back.count() == len(expected)
    # the same run again changes nothing
    upsert_partitions(spark, str(path), given, "k", "p")
    back = spark.read.schema(schema).parquet(str(path))
    assert {r.k: tuple(r) for r in back.collect()} == expected and back.count() == len(expected)


def test_partitioned_upsert_drops_a_partition_without_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(1, 1, 2020), (2, 2, 2021), (3, 3, None)]
    spark.createDataFrame(rows, "k int, v int, p int").write.partitionBy("p").parquet(path)
    updates = spark.createDataFrame([(1, 9, 2021), (3, 9, 2021)], "k int, v int, p int")
    upsert_partitions(spark, path, updates, ["k"], "p")
    back = spark.read.schema("k int, v int, p int").parquet(path).collect()
    assert sorted(map(tuple, back)) == [(1, 9, 2021), (2, 2, 2021), (3, 9, 2021)]
    assert [f.name for f in (tmp_path / "table").iterdir() if f.is_dir()] == ["p=2021"]


def test_more_input_gives_more_partitions(spark, sf_dir, monkeypatch):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    monkeypatch.setattr(numbering, "PARTITION_BYTES", 10_000)
    numbered = numbering.number_rows(orders, "o_orderkey")
    parts = numbered.select(F.input_file_name()).distinct().count()
    assert parts > 8 and numbered.where("rownum = 15000").count() == 1


def regression_rows(spark, rows=3000):
    return spark.range(rows).selectExpr(
        "id", "id % 50 AS a", "hash(id) % 100 / 10.0 AS b", "CAST(id % 7 + id % 50 AS double) AS c",
        "3.0 AS same",
    ).selectExpr("*", "2 * a - 3 * b + 0.5 * c + 7 + hash(id, 1) % 1000 / 300.0 AS y")


@pytest.mark.parametrize("setting", regression.GRID)
def test_moments_solve_what_spark_ml_solves(spark, setting):
    from pyspark.ml.regression import LinearRegression

    columns, rows = ["a", "b", "c"], regression_rows(spark)
    moments = regression.moments_by_part(rows, columns, "y", F.lit(True))[True]
    mine = regression.solve(moments, setting)
    data = regression.with_features(rows, columns, "y")
    model = LinearRegression(
        maxIter=100_000, tol=1e-15, regParam=setting.reg_param,
        elasticNetParam=setting.elastic_net, fitIntercept=setting.fit_intercept,
    ).fit(data)
    assert mine.coefficients == pytest.approx(model.coefficients.toArray(), abs=1e-5)
    assert mine.intercept == pytest.approx(model.intercept, abs=1e-4)
    assert regression.rmse(moments, mine) == pytest.approx(model.summary.rootMeanSquaredError, abs=1e-6)
    predicted = rows.select(F.sum(mine.predict(columns))).first()[0]
    assert predicted == pytest.approx(model.transform(data).select(F.sum("prediction")).first()[0])


def test_tuning_reads_its_rows_once_and_judges_by_the_rest(spark, sf_dir, tmp_path):
    path = str(tmp_path / "rows")
    regression_rows(spark).write.parquet(path)
    rows = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("tuning", "")
    tuned = regression.tune(rows, ["a", "b"], "y", "id")
    spark.sparkContext.setJobGroup("other", "")
    store, tracker = spark._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("tuning") for s in tracker.getJobInfo(j).stageIds]
    read = 0
    for stage in set(stages):
        read += store.lastStageAttempt(stage).inputRecords()
    assert read == 3000
    judged = rows.where(regression.split_slot(["id"], regression.VALIDATION_SEED) >= 0.8)
    fitted = rows.where(regression.split_slot(["id"], regression.VALIDATION_SEED) < 0.8)
    moments = regression.moments_by_part(fitted, ["a", "b"], "y", F.lit(1))[1]
    for setting, error in tuned.errors:
        model = regression.solve(moments, setting)
        off = F.col("y") - model.predict(["a", "b"])
        assert error == pytest.approx(judged.select(F.sqrt(F.avg(off * off))).first()[0])
    assert dict(tuned.errors)[tuned.setting] == min(e for _, e in tuned.errors)


def test_tuning_of_odd_columns(spark):
    rows = regression_rows(spark)
    tuned = regression.tune(rows, ["same", "a"], "y", "id")
    assert tuned.model.coefficients[0] == 0
    with_null = rows.unionByName(rows.withColumn("y", F.lit(None).cast(rows.schema["y"].dataType)))
    plain, more = (regression.tune(r, ["a"], "y", "id").errors for r in (rows, with_null))
    assert [e for _, e in more] == pytest.approx([e for _, e in plain])
    flat = regression.tune(rows.withColumn("y", F.lit(4.0)), ["a"], "y", "id")
    assert flat.model.coefficients == (0.0,)
    with pytest.raises(ValueError, match="too few"):
        regression.tune(rows.limit(0), ["a"], "y", "id")
