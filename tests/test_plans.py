"""The physical plans the operators are meant to get."""

from __future__ import annotations

import re

import pytest

from tablecheck.functions import predicates as P
from tablecheck.operators import catalog, checks, marks, state
from tablecheck.operators.upsert import upsert_by_key
from workload.queries import QUERIES
from workload.tables import dirty_customer, stateful_orders, table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> int:
    return text.count("FileScan parquet")


LAZY = (
    "regex_check regex_check_by_group multi_rule_check null_check blank_check mask_name mask_phone "
    "mask_id_card mask_mail sql_udf_masks row_to_json invalid_marks illegal_sample "
    "null_check_with_state blank_check_with_state upsert_by_key encrypt_column quality_score "
    "catalog_by_class_semi stamp_check_state macro_summary"
).split()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Cartesian", "NestedLoop", "Arrow"):
        assert word not in text


def test_many_rules_scan_once_and_aggregate_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["multi_rule_check"](spark, sf_dir))
    assert scans(text) == 1
    assert text.count("Exchange") == 1
    assert text.index("partial_count") > text.index("Exchange")


def test_check_reads_one_column(spark, sf_dir):
    text = plan(checks.regex_check(table(spark, sf_dir, "orders"), "o_orderpriority", "^1"))
    assert "ReadSchema: struct<o_orderpriority:string>" in text


def test_marks_are_map_only_and_read_two_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(marks.invalid_marks(orders, "o_orderkey", "o_orderpriority", "^1", "m", "t"))
    assert "Exchange" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text


def test_sample_is_a_top_k(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = plan(marks.illegal_sample(orders, "o_orderpriority", "1.*", "o_orderkey"))
    assert text.count("TakeOrderedAndProject") == 1 and "Exchange" not in text
    assert scans(text) == 1


def test_sample_of_a_clustered_table_finds_keys_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    found = marks.illegal_sample(orders, "o_orderpriority", "1.*", "o_orderkey", clustered=True)
    text = plan(found)
    assert text.count("TakeOrderedAndProject") >= 2
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text
    assert re.search(r"LessThanOrEqual\(o_orderkey,ScalarSubquery", text)
    plain = marks.illegal_sample(orders, "o_orderpriority", "1.*", "o_orderkey")
    assert found.collect() == plain.collect()


@pytest.mark.parametrize("name", ["null_check_with_state", "blank_check_with_state"])
def test_state_update_is_map_only(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Exchange" not in text and scans(text) == 1


def test_incremental_filter_is_pushed(spark, sf_dir):
    text = plan(QUERIES["incremental_scan"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1998-09-01T00:00)" in text


def test_masks_stay_in_generated_code(spark, sf_dir):
    for name in ("mask_phone", "sql_udf_masks"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert re.search(r"\*\(\d+\) Project", text)


def test_upsert_shuffles_update_keys_only_once(spark, sf_dir):
    orders = stateful_orders(spark, sf_dir).select("o_orderkey", "checked", "jcsjc")
    updates = state.state_updates(orders, P.not_null("checked"), "2024-06-01 12:00:00")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(upsert_by_key(orders, updates, "o_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2


def test_class_lookup_folds_ids_before_the_shuffle(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS classify_id", "l_partkey AS catalog_id"
    )
    customers = dirty_customer(spark, sf_dir).select("id", "name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog.resources_of_class(customers, lines, 7, {"id": "id"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("HashAggregate") == 2


def test_numbers_are_added_without_a_shuffle(spark, sf_dir):
    """The one shuffle took place when the ordered rows were written."""
    text = plan(QUERIES["row_number_global"](spark, sf_dir))
    assert "Python" not in text and "Exchange" not in text and "Window" not in text
    assert "Join" not in text
