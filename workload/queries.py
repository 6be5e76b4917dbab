"""Registered queries. Each reads whole test tables (or views derived from them)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.functions import masks, text
from tablecheck.functions import predicates as P
from tablecheck.functions.crypto import decrypt_text, encrypt_text
from tablecheck.operators import catalog, checks, marks, numbering, regression, state
from tablecheck.operators.upsert import upsert_by_key, upsert_partitions
from tablecheck.plans import jobs
from tablecheck.rules import Rule, rules_from_json
from tablecheck.session import scratch_path
from tablecheck.sources import files, jdbc, jsonlines, tables
from tablecheck.sources.dialects import default_mark_table, type_of_url
from workload.database import PARTITIONS, database, load
from workload.tables import (
    HARD_TEXT,
    dirty_customer,
    graded_documents,
    stateful_orders,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHECK_TIME = "2024-06-01 12:00:00"
JOB_ID = "job-1"
PRIORITY = "^[12]-"
PRIORITY_FULL = "[12]-.*"
SINCE = "1998-09-01"

# Example key and vector, for the round trip only.
EXAMPLE_KEY = b"0123456789abcdef"
EXAMPLE_IV = b"fedcba9876543210"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources


@query
def scan_table(spark, sf):
    return files.read_source(spark, "parquet", path=f"{sf}/orders.parquet")


@query
def generic_source(spark, sf):
    """A source of the library's own; it takes the filters on status and key."""
    path = scratch_path(spark, "lines")
    orders = table(spark, sf, "orders")
    orders.write.json(path, ignoreNullFields=False)
    jsonlines.register(spark)
    options = {"partitionBytes": str(2**20)}
    lines = files.read_source(spark, jsonlines.NAME, options, path, orders.schema)
    return lines.where("o_orderstatus = 'F' AND o_custkey > 100 AND o_totalprice < 200000")


def _year_table(spark, sf, name):
    """Orders as a catalogue table with a partition for each year; its files in scratch."""
    orders = table(spark, sf, "orders").withColumn("o_year", F.year("o_orderdate"))
    spark.sql("CREATE DATABASE IF NOT EXISTS tablecheck_shop")
    spark.sql(f"DROP TABLE IF EXISTS tablecheck_shop.{name}")
    tables.write_table(
        orders,
        "hive",
        "tablecheck_shop",
        name,
        "overwrite",
        partition_by="o_year",
        path=scratch_path(spark, name),
    )
    return tables.read_table(spark, "hive", "tablecheck_shop", name)


@query
def metastore_scan(spark, sf):
    """Static pruning by a filter, dynamic pruning by the years that a join leaves."""
    orders = _year_table(spark, sf, "orders_by_year")
    busy = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("o_year"))
    years = busy.agg(F.count("*").alias("lines")).where("o_year % 2 = 0")
    return orders.where("o_year >= 1993").join(years, "o_year").drop("lines")


@query
def dispatched_copy(spark, sf):
    """Catalogue table to database and back, source and sink chosen by the kind of database."""
    orders = _year_table(spark, sf, "orders_to_copy").select("o_orderkey", "o_orderpriority")
    options = load(orders.limit(0), "TCQ_COPY", key="o_orderkey")
    kind = type_of_url(options["url"])
    for mode in ("append", "update"):
        tables.write_table(orders, kind, "", "TCQ_COPY", mode, options, "o_orderkey", PARTITIONS)
    return tables.read_table(spark, kind, "", "TCQ_COPY", options, "o_orderkey", PARTITIONS)


@query
def incremental_scan(spark, sf):
    return files.rows_since(table(spark, sf, "orders"), "o_orderdate", SINCE)


@query
def partition_bounds(spark, sf):
    return numbering.partition_bounds(table(spark, sf, "orders"), "o_orderkey")


@query
def jdbc_scan(spark, sf):
    options = load(table(spark, sf, "customer"), "TCQ_SCAN")
    return jdbc.read_jdbc(spark, options, "TCQ_SCAN")


@query
def jdbc_partitioned_scan(spark, sf):
    options = load(table(spark, sf, "orders"), "TCQ_PARTS")
    return jdbc.read_jdbc_partitioned(spark, options, "TCQ_PARTS", "o_orderkey", PARTITIONS)


@query
def jdbc_balanced_scan(spark, sf):
    # keys bunched at the low end: equal strides would put most rows into one
    bunched = table(spark, sf, "orders").select(
        (F.col("o_orderkey") * F.col("o_orderkey")).alias("k"), "o_orderpriority"
    )
    options = load(bunched, "TCQ_BALANCED")
    return jdbc.read_jdbc_balanced(spark, options, "TCQ_BALANCED", "k", PARTITIONS)


@query
def jdbc_incremental_scan(spark, sf):
    options = load(table(spark, sf, "orders"), "TCQ_SINCE")
    orders = jdbc.read_jdbc_partitioned(spark, options, "TCQ_SINCE", "o_orderkey", PARTITIONS)
    recent = files.rows_since(orders, "o_orderdate", SINCE)
    return recent.select("o_orderkey", "o_orderpriority")


@query
def jdbc_hashed_scan(spark, sf):
    """By a text key that is NULL or empty in a large part of the rows."""
    customers = dirty_customer(spark, sf)
    options = load(customers, "TCQ_HASHED")
    return jdbc.read_jdbc_hashed(spark, options, "TCQ_HASHED", ["phone", "id"], PARTITIONS)


@query
def jdbc_hot_key_scan(spark, sf):
    """Nine tenths of the rows have one key."""
    hot = table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 10 > 0 THEN 5 ELSE o_orderkey END AS k",
        "o_custkey",
        "o_orderpriority",
    )
    options = load(hot, "TCQ_HOT")
    return jdbc.read_jdbc_balanced(spark, options, "TCQ_HOT", "k", PARTITIONS)


@query
def jdbc_bounds(spark, sf):
    options = load(table(spark, sf, "orders"), "TCQ_BOUNDS")
    return jdbc.read_bounds(spark, options, "TCQ_BOUNDS", "o_orderkey")


@query
def libsvm_scan(spark, sf):
    columns = ["l_quantity", "l_discount", "l_tax"]
    path = scratch_path(spark, "libsvm")
    rows = regression.with_features(table(spark, sf, "lineitem"), columns, "l_extendedprice")
    rows.select("label", "features").write.format("libsvm").save(path)
    back = files.read_libsvm(spark, path, len(columns))
    values = vector_to_array("features")
    return back.select("label", *[values[i].alias(c) for i, c in enumerate(columns)])


def _catalogue(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.upper("p_name").alias("original_name"),
        F.col("p_type").alias("description"),
        F.col("p_size").alias("open_property"),
        F.col("p_brand").alias("open_condition"),
        F.lit(0).alias("deleted"),
        F.lit("2018-12-17 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2018-12-18 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("structured"),
    )


@query
def catalog_list(spark, sf):
    return catalog.list_resources(_catalogue(spark, sf))


@query
def catalog_by_class(spark, sf):
    mapper = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("classify_id"), F.col("o_custkey").alias("catalog_id")
    )
    return catalog.resource_of_class(_catalogue(spark, sf), mapper, 7)


@query
def catalog_by_class_semi(spark, sf):
    mapper = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("classify_id"), F.col("l_partkey").alias("catalog_id")
    )
    return catalog.resources_of_class(_catalogue(spark, sf), mapper, 7)


# Sinks


@query
def csv_roundtrip(spark, sf):
    customers, path = dirty_customer(spark, sf), scratch_path(spark, "csv")
    customers = customers.selectExpr("id", f"{HARD_TEXT} AS hard", "phone", "mail")
    files.write_csv(customers, path, null_text="\\N")
    return files.read_csv(spark, path, customers.schema, null_text="\\N")


@query
def sorted_export(spark, sf):
    orders, path = table(spark, sf, "orders"), scratch_path(spark, "sorted")
    files.write_csv(files.sort_for_export(orders, "o_orderdate", ["o_orderkey"]), path)
    return files.read_csv(spark, path, orders.schema)


@query
def split_legal_illegal(spark, sf):
    path = scratch_path(spark, "split")
    orders = stateful_orders(spark, sf).select("o_orderkey", "checked")
    flagged = state.flag_rows(orders, P.not_null("checked"))
    files.write_split(flagged, path, "is_legal")
    return files.read_split(spark, path, flagged.schema)


@query
def sql_over_view(spark, sf):
    with files.global_view(table(spark, sf, "orders"), "tablecheck_orders") as view:
        return spark.sql(
            f"SELECT o_orderkey, o_orderpriority FROM {view} "
            f"WHERE cast(o_orderpriority AS string) RLIKE r'{PRIORITY}'"
        )


@query
def jdbc_append_roundtrip(spark, sf):
    """NULL, empty and long texts, each row twice, in an order that no run repeats."""
    customers = dirty_customer(spark, sf).selectExpr(
        "id", "name", "phone", "repeat(name, 100) AS long", f"{HARD_TEXT} AS hard"
    )
    shuffled = customers.unionByName(customers).repartition(PARTITIONS, F.rand())
    options = load(customers.limit(0), "TCQ_APPEND")
    jobs.copy_job(shuffled, options, "TCQ_APPEND", partitions=PARTITIONS)
    return jdbc.read_jdbc_partitioned(spark, options, "TCQ_APPEND", "id", PARTITIONS)


@query
def jdbc_copy_once(spark, sf):
    """The same copy run twice; the second run adds nothing."""
    customers = table(spark, sf, "customer")
    options = load(customers.limit(0), "TCQ_ONCE", key="c_custkey")
    for _ in range(2):
        jobs.copy_job(
            customers,
            options,
            "TCQ_ONCE",
            key="c_custkey",
            partitions=PARTITIONS,
        )
    return jdbc.read_jdbc_partitioned(spark, options, "TCQ_ONCE", "c_custkey", PARTITIONS)


@query
def jdbc_overwrite_roundtrip(spark, sf):
    customers = table(spark, sf, "customer")
    options = load(table(spark, sf, "supplier"), "TCQ_OVERWRITE")
    jobs.copy_job(
        customers, options, "TCQ_OVERWRITE", mode="overwrite")
    return jdbc.read_jdbc_partitioned(spark, options, "TCQ_OVERWRITE", "c_custkey", PARTITIONS)


def _orders_and_updates(spark, sf):
    """All orders; a new priority for the finished ones; as new orders the pending ones."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    changed = orders.where("o_orderstatus = 'F'").withColumn(
        "o_orderpriority", F.upper(F.concat(F.lit("new "), "o_orderpriority"))
    )
    added = orders.where("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return orders, changed.unionByName(added)


def _upserted(spark, sf):
    orders, updates = _orders_and_updates(spark, sf)
    return upsert_by_key(orders, updates, "o_orderkey")


QUERIES["upsert_by_key"] = _upserted


@query
def upsert_partitioned(spark, sf):
    """A table of files with a partition for each year: changed, moved and new rows."""
    path = scratch_path(spark, "years")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("o_year")
    )
    orders.hint("rebalance", "o_year").write.partitionBy("o_year").parquet(path)
    changed = orders.where("o_year = 1996").withColumn("o_orderpriority", F.lit("new"))
    moved = orders.where("o_year = 1993").withColumn("o_year", F.lit(2030))
    added = orders.where("o_year = 1998").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    updates = changed.unionByName(moved).unionByName(added)
    upsert_partitions(spark, path, updates, "o_orderkey", "o_year")
    return spark.read.schema(orders.schema).parquet(path)


@query
def jdbc_merge(spark, sf):
    orders, updates = _orders_and_updates(spark, sf)
    options = load(orders, "TCQ_MERGE", key="o_orderkey")
    jdbc.merge_jdbc(
        updates, options, "TCQ_MERGE", "o_orderkey", PARTITIONS)
    return jdbc.read_jdbc_partitioned(spark, options, "TCQ_MERGE", "o_orderkey", PARTITIONS)


def _marks(spark, sf):
    return marks.invalid_marks(
        stateful_orders(spark, sf), "o_orderkey", "checked", PRIORITY, "bad priority", CHECK_TIME
    )


@query
def mark_table_roundtrip(spark, sf):
    rows, options = _marks(spark, sf), database(spark)
    marks_of = default_mark_table(type_of_url(options["url"]), "TCQ_CHECKED")
    load(rows.limit(0), marks_of)
    jdbc.write_marks_jdbc(rows, options, marks_of)
    return jdbc.read_jdbc_hashed(spark, options, marks_of, "SOURCE_TABLE_PK", PARTITIONS)


# Projections and filters


@query
def project_alias(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.upper("c_mktsegment").alias("segment"),
        F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_name").alias("label"),
    )


@query
def drop_columns(spark, sf):
    return stateful_orders(spark, sf).drop("jcsjc", "checked")


@query
def stamp_check_state(spark, sf):
    return state.stamp(stateful_orders(spark, sf), CHECK_TIME).select("o_orderkey", "jcsjc")


@query
def row_to_json(spark, sf):
    customers = dirty_customer(spark, sf)
    return customers.select("id", text.row_json(customers.columns).alias("json"))


@query
def null_legal_rows(spark, sf):
    return graded_documents(spark, sf).where(P.not_null("quality"))


@query
def null_illegal_rows(spark, sf):
    return graded_documents(spark, sf).where(~P.not_null("quality")).drop("quality")


@query
def blank_legal_rows(spark, sf):
    return state.split_rows(dirty_customer(spark, sf), P.not_blank("phone"))[0]


@query
def blank_illegal_rows(spark, sf):
    return state.split_rows(dirty_customer(spark, sf), P.not_blank("phone"))[1]


@query
def invalid_marks(spark, sf):
    return _marks(spark, sf)


def _sample(spark, sf):
    return marks.illegal_sample(
        stateful_orders(spark, sf), "checked", PRIORITY_FULL, "o_orderkey"
    )


@query
def illegal_sample(spark, sf):
    return _sample(spark, sf).drop("jcsjc")


@query
def illegal_detail(spark, sf):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "checked"]
    return marks.detail_rows(_sample(spark, sf), JOB_ID, columns)


@query
def pending_sentinel(spark, sf):
    return state.pending_rows(stateful_orders(spark, sf), "sentinel")


@query
def pending_null(spark, sf):
    return state.pending_rows(stateful_orders(spark, sf), "null")


# Checks


@query
def row_count(spark, sf):
    return checks.row_count(table(spark, sf, "lineitem"))


@query
def null_check(spark, sf):
    return checks.null_check(graded_documents(spark, sf), "quality")


@query
def null_check_by_group(spark, sf):
    return checks.null_check(graded_documents(spark, sf), "quality", by=["lang"])


@query
def blank_check(spark, sf):
    return checks.blank_check(dirty_customer(spark, sf), "phone")


@query
def regex_check(spark, sf):
    return checks.regex_check(table(spark, sf, "orders"), "o_orderpriority", PRIORITY)


@query
def regex_check_nulls(spark, sf):
    """A pattern that matches the empty text: rows both legal and empty."""
    return checks.regex_check(stateful_orders(spark, sf), "checked", "^([12]-.*)?")


@query
def regex_check_long_text(spark, sf):
    return checks.regex_check(table(spark, sf, "documents"), "text", "[A-Za-z0-9.]+@[a-z]+[.][a-z]+")


@query
def regex_check_by_group(spark, sf):
    return checks.regex_check(
        stateful_orders(spark, sf), "checked", PRIORITY, by=["o_orderstatus"]
    )


@query
def regex_legal_count(spark, sf):
    return checks.regex_check(table(spark, sf, "orders"), "o_orderpriority", PRIORITY).select("legal")


@query
def null_or_empty_count(spark, sf):
    orders = stateful_orders(spark, sf)
    return orders.agg(F.count_if(P.null_or_empty("checked")).alias("null_or_empty"))


@query
def illegal_full_match_count(spark, sf):
    return checks.illegal_full_match_count(stateful_orders(spark, sf), "checked", PRIORITY_FULL)


@query
def quality_score(spark, sf):
    """One exact score per customer."""
    orders = table(spark, sf, "orders")
    scored = checks.regex_check(orders, "o_orderpriority", PRIORITY, by=["o_custkey"])
    return scored.select("o_custkey", "total", "legal", "score")


@query
def macro_summary(spark, sf):
    check = checks.regex_check(stateful_orders(spark, sf), "checked", PRIORITY)
    rows = checks.macro_summary(check, "regex check", JOB_ID, CHECK_TIME)
    return rows.withColumn("Checktime", text.timestamp_text("Checktime"))


ORDER_RULES = (
    Rule("checked", regex=PRIORITY, name="priority"),
    Rule("o_orderstatus", regex="[FO]", mode="full", name="closed"),
    Rule("checked", kind="null", name="present"),
    Rule("checked", kind="blank", name="filled"),
)


@query
def multi_rule_check(spark, sf):
    return checks.multi_rule_check(stateful_orders(spark, sf), ORDER_RULES)


@query
def rule_template_check(spark, sf):
    template = (Path(__file__).parent / "rules.json").read_text(encoding="utf-8")
    return checks.multi_rule_check(dirty_customer(spark, sf), rules_from_json(template))


# Numbering


@query
def row_number_global(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return numbering.number_rows(orders, "o_orderkey")


@query
def row_number_ranged(spark, sf):
    """Order columns with ties: rows of a tie differ in no selected column."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return numbering.number_rows(lines, ["l_orderkey", "l_linenumber"])


@query
def row_number_hot_key(spark, sf):
    """Three values only: each is a third of all rows, and its rows are copies."""
    status = table(spark, sf, "orders").select("o_orderstatus")
    return numbering.number_rows(status, "o_orderstatus")


@query
def pending_numbered(spark, sf):
    pending = state.pending_rows(stateful_orders(spark, sf), "sentinel")
    return numbering.number_rows(pending.select("o_orderkey", "checked"), "o_orderkey")


# Scalars


@query
def mask_name(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", masks.mask_name("c_name").alias("name"), masks.mask_name("c_mktsegment").alias("segment")
    )


@query
def mask_phone(spark, sf):
    return dirty_customer(spark, sf).select("id", masks.mask_phone("phone").alias("phone"))


@query
def mask_id_card(spark, sf):
    return dirty_customer(spark, sf).select(
        "id",
        masks.mask_id_card("id_card").alias("id_card"),
        masks.mask_id_card("id_card", accept_upper_x=True).alias("id_card_upper"),
    )


@query
def mask_mail(spark, sf):
    return dirty_customer(spark, sf).select("id", masks.mask_mail("mail").alias("mail"))


MASK_SELECT = """
SELECT id, name_rm_sensitive(name) AS name, phone_rm_sensitive(phone) AS phone,
       cerdID_rm_sensitive(id_card) AS id_card, mail_rm_sensitive(mail) AS mail
FROM sourceData
"""


@query
def sql_udf_masks(spark, sf):
    entry = jobs.ExportEntry("customer", dirty_customer(spark, sf), select=MASK_SELECT)
    return jobs.export_rows(entry)


def _contacts(spark, sf):
    """Every order with the contact data of its customer, loaded at the order date."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = dirty_customer(spark, sf).withColumnRenamed("id", "o_custkey")
    return orders.join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("id"),
        "name",
        "phone",
        "mail",
        F.col("o_orderdate").alias("ldsjc"),
    )


@query
def export_masked(spark, sf):
    """Plain, masked and selected tables, exported since a date and read back."""
    contacts = _contacts(spark, sf)
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").alias("ldsjc"),
    )
    entries = [
        jobs.ExportEntry("plain", orders),
        jobs.ExportEntry("hard", contacts.selectExpr("id", f"{HARD_TEXT} AS name", "ldsjc")),
        jobs.ExportEntry("masked", contacts.select("id", "name", "ldsjc"), masks={"name": "name"}),
        jobs.ExportEntry(
            "selected",
            contacts,
            select="SELECT id, mail_rm_sensitive(mail) AS name, ldsjc FROM sourceData",
        ),
    ]
    folder = scratch_path(spark, "export")
    paths = jobs.export_job(entries, folder, since=("ldsjc", SINCE), null_text="\\N")
    schema = "id long, name string, ldsjc timestamp_ntz"
    parts = [
        files.read_csv(spark, path, schema, null_text="\\N").select(F.lit(name).alias("entry"), "*")
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def strip_quotes(spark, sf):
    quoted = F.concat(F.lit("'"), "c_name", F.lit("'"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.strip_quotes(quoted).alias("unquoted"),
        text.strip_quotes(F.concat(F.lit("'"), "c_name")).alias("half_quoted"),
    )


@query
def concat_columns(spark, sf):
    return dirty_customer(spark, sf).select(
        "id", text.join_columns(",", ["name", "phone", "mail"]).alias("joined")
    )


@query
def last_name_part(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.last_name_part("url").alias("last_part")
    )


@query
def format_timestamp(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        text.timestamp_text("ts").alias("ts_text"),
        text.timestamp_text(F.to_date("ts")).alias("day_text"),
    )


@query
def encrypt_column(spark, sf):
    """Round trip of both forms; the cipher text differs from the plain text."""
    customers = dirty_customer(spark, sf)
    fixed = encrypt_text("phone", EXAMPLE_KEY, EXAMPLE_IV)
    own = encrypt_text("phone", EXAMPLE_KEY)
    sealed = customers.select("id", "phone", fixed.alias("fixed"), own.alias("own"))
    return sealed.select(
        "id",
        decrypt_text("fixed", EXAMPLE_KEY, EXAMPLE_IV).alias("from_fixed"),
        decrypt_text("own", EXAMPLE_KEY).alias("from_own"),
        (~F.col("fixed").eqNullSafe(F.col("phone"))).alias("sealed"),
    )


@query
def decrypt_column(spark, sf):
    """Text that is no cipher text gives NULL."""
    return dirty_customer(spark, sf).select(
        "id", decrypt_text("name", EXAMPLE_KEY, EXAMPLE_IV).alias("plain")
    )


# Checks with state


@query
def null_check_with_state(spark, sf):
    orders = stateful_orders(spark, sf)
    checked = state.check_with_state(orders, P.not_null("checked"), CHECK_TIME, "sentinel")
    return checked.select("o_orderkey", "checked", "jcsjc")


@query
def blank_check_with_state(spark, sf):
    orders = stateful_orders(spark, sf)
    checked = state.check_with_state(
        orders, P.not_blank("checked"), CHECK_TIME, "null", stamp_illegal=False
    )
    return checked.select("o_orderkey", "checked", "jcsjc")


@query
def null_check_state_job(spark, sf):
    """The whole job on files: stage, count, merge by key, read the new table."""
    orders = stateful_orders(spark, sf).select("o_orderkey", "checked", "jcsjc")
    path = scratch_path(spark, "merged")
    jobs.state_check_job(
        orders,
        P.not_null("checked"),
        check_time=CHECK_TIME,
        merge=lambda updates: upsert_by_key(orders, updates, "o_orderkey").write.parquet(path),
    )
    return spark.read.parquet(path)


@query
def jdbc_null_check_state_job(spark, sf):
    """The whole job in the database: partitioned pending scan, keyed merge."""
    orders = stateful_orders(spark, sf).select("o_orderkey", "checked", "jcsjc")
    options = load(orders, "TCQ_STATE", types={}, key="o_orderkey")
    source = jdbc.read_jdbc_partitioned(spark, options, "TCQ_STATE", "o_orderkey", PARTITIONS)
    jobs.state_check_job(
        source,
        P.not_null("checked"),
        check_time=CHECK_TIME,
        keep=["o_orderkey"],
        merge=lambda updates: jdbc.update_jdbc(
            updates, options, "TCQ_STATE", "o_orderkey", PARTITIONS
        ),
    )
    return jdbc.read_jdbc_partitioned(spark, options, "TCQ_STATE", "o_orderkey", PARTITIONS)


@query
def jdbc_blank_check_state_job(spark, sf):
    """Blank check of the rows without a state; only legal ones get a time.

    The table has a column that must not be NULL and is not part of the update.
    """
    orders = stateful_orders(spark, sf).select(
        "o_orderkey", "checked", "jcsjc", F.lit(1).alias("required")
    )
    options = load(orders, "TCQ_BLANK", types={}, key="o_orderkey")
    source = jdbc.read_jdbc_partitioned(spark, options, "TCQ_BLANK", "o_orderkey", PARTITIONS)
    jobs.state_check_job(
        source,
        P.not_blank("checked"),
        check_time=CHECK_TIME,
        form="null",
        stamp_illegal=False,
        keep=["o_orderkey"],
        merge=lambda updates: jdbc.update_jdbc(
            updates, options, "TCQ_BLANK", "o_orderkey", PARTITIONS
        ),
    )
    return jdbc.read_jdbc_partitioned(
        spark, options, "TCQ_BLANK", "o_orderkey", PARTITIONS
    ).drop("required")


MODES = {"find": PRIORITY, "full": PRIORITY_FULL}


def _job_source(spark, sf):
    return stateful_orders(spark, sf).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "checked"
    )


def _sink_rows(mode, sink, rows):
    """Rows of any sink as seven texts."""
    texts = [F.col(c).cast("string") for c in rows.columns]
    texts += [F.lit(None).cast("string")] * (7 - len(texts))
    own = [F.lit(mode).alias("mode"), F.lit(sink).alias("sink")]
    return rows.select(*own, *[c.alias(f"c{i}") for i, c in enumerate(texts, 1)])


@query
def regex_check_job(spark, sf):
    """The whole job in both modes; the rows that each of its four sinks got."""
    found = []
    for mode, regex in MODES.items():
        folder = scratch_path(spark, "job")
        names = ("marks", "macro", "detail", "result")

        def sink(name, folder=folder):
            return lambda df: df.write.parquet(f"{folder}/{name}")

        jobs.regex_check_job(
            _job_source(spark, sf),
            Rule("checked", regex=regex, mode=mode, message="bad priority"),
            "o_orderkey",
            job_id=JOB_ID,
            task_name="regex check",
            check_time=CHECK_TIME,
            sinks=jobs.CheckSinks(**{name: sink(name) for name in names}),
        )
        found += [_sink_rows(mode, n, spark.read.parquet(f"{folder}/{n}")) for n in names]
    return reduce(DataFrame.unionByName, found)


@query
def jdbc_regex_check_job(spark, sf):
    """The job from and to a database, in both modes; its tables change together."""
    source = _job_source(spark, sf)
    options, found = load(source, "TCQ_JOB"), []
    for mode, regex in MODES.items():
        name, kind = f"TCQ_{mode.upper()}", type_of_url(options["url"])
        marks_of = default_mark_table(kind, name)
        tables = jobs.ResultTables(
            macro=f"{name}_MACRO", detail=f"{name}_DETAIL", result=f"{name}_RESULT"
        )
        for old in (marks_of, tables.macro, tables.detail):
            jdbc.drop_table(spark, options, old)
        older = spark.createDataFrame([(JOB_ID, "{}", 0.0)], "spark_job_id string, result string, score double")
        load(older, tables.result, key="spark_job_id")
        jobs.regex_check_to_database(
            jdbc.read_jdbc_partitioned(spark, options, "TCQ_JOB", "o_orderkey", PARTITIONS),
            Rule("checked", regex=regex, mode=mode, message="bad priority"),
            "o_orderkey",
            options,
            name,
            tables,
            job_id=JOB_ID,
            task_name="regex check",
            check_time=CHECK_TIME,
        )
        keys = {
            "marks": (marks_of, "SOURCE_TABLE_PK"),
            "macro": (tables.macro, "checktype"),
            "detail": (tables.detail, "illgeadata"),
            "result": (tables.result, "spark_job_id"),
        }
        found += [
            _sink_rows(mode, n, jdbc.read_jdbc_hashed(spark, options, t, key, PARTITIONS))
            for n, (t, key) in keys.items()
        ]
    return reduce(DataFrame.unionByName, found)


@query
def pending_state_counts(spark, sf):
    """Counts and score of the pending rows only."""
    pending = state.pending_rows(stateful_orders(spark, sf), "sentinel")
    return checks.null_check(pending, "checked")


@query
def result_writeback(spark, sf):
    """One result row per customer, merged by job id over older results."""
    orders = table(spark, sf, "orders")
    key = F.concat(F.lit("job-"), F.col("o_custkey").cast("string"))
    scored = checks.regex_check(orders, "o_orderpriority", PRIORITY, by=["o_custkey"])
    new = scored.select(
        key.alias("spark_job_id"), F.col("legal").cast("string").alias("result"), "score"
    )
    old = new.select("spark_job_id", F.lit("").alias("result"), F.lit(0.0).alias("score"))
    options = load(old, "TCQ_RESULT", key="spark_job_id")
    jdbc.merge_jdbc(new, options, "TCQ_RESULT", "spark_job_id", PARTITIONS)
    return jdbc.read_jdbc_hashed(spark, options, "TCQ_RESULT", "spark_job_id", PARTITIONS)


# Regression


@query
def split_sizes(spark, sf):
    train, test = regression.split_by_key(table(spark, sf, "orders"), "o_orderkey")
    sizes = [
        part.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        for name, part in (("train", train), ("test", test))
    ]
    return sizes[0].unionByName(sizes[1])


def _regression_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    return regression.with_features(lines, ["l_quantity"], "l_extendedprice")


@query
def linreg_fit(spark, sf):
    model = regression.fit_linear(_regression_rows(spark, sf).select("features", "label"))
    row = (round(float(model.coefficients[0]), 4), round(float(model.intercept), 4))
    return spark.createDataFrame([row], "slope double, intercept double")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


@query
def linreg_scored(spark, sf):
    """Fit on the training share, score the rest."""
    train, test = regression.split_by_key(_regression_rows(spark, sf), LINE_KEY)
    model = regression.fit_linear(train.select("features", "label"))
    scored = regression.score(model, test, LINE_KEY)
    return scored.select(*LINE_KEY, "label", F.round("prediction", 2).alias("prediction"))


FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _tuned(spark, sf):
    train, test = regression.split_by_key(table(spark, sf, "lineitem"), LINE_KEY)
    return regression.tune(train, FEATURES, "l_extendedprice", LINE_KEY), test


@query
def linreg_grid(spark, sf):
    """The validation error of every setting, all from one aggregation."""
    tuned, _ = _tuned(spark, sf)
    rows = [
        (s.reg_param, s.fit_intercept, s.elastic_net, round(error, 4), s == tuned.setting)
        for s, error in tuned.errors
    ]
    schema = "reg_param double, fit_intercept boolean, elastic_net double, rmse double, wins boolean"
    return spark.createDataFrame(rows, schema)


@query
def linreg_tuned(spark, sf):
    """Held-out rows scored by the winner, fitted on all training rows."""
    tuned, test = _tuned(spark, sf)
    prediction = F.round(tuned.model.predict(FEATURES), 2).alias("prediction")
    return test.select(*LINE_KEY, F.col("l_extendedprice").alias("label"), prediction)
