"""Test tables and the views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Key texts are padded to a width that grows with the key, never cut.
DIRTY_CUSTOMER = """
SELECT c_custkey AS id, c_name AS name,
  CASE WHEN c_custkey%11=0 THEN NULL WHEN c_custkey%7=0 THEN ''
       WHEN c_custkey%5=0  THEN '0791-'||lpad(cast(c_custkey AS {text}),7,'0')
       WHEN c_custkey%3=0  THEN '0138'||lpad(cast(c_custkey AS {text}),8,'0')
       WHEN c_custkey%13=0 THEN '12'
       WHEN c_custkey%2=0  THEN '166'||lpad(cast(c_custkey AS {text}),8,'0')
       ELSE '138'||lpad(cast(c_custkey AS {text}),8,'0') END AS phone,
  CASE WHEN c_custkey%11=0 THEN NULL WHEN c_custkey%7=0 THEN ''
       WHEN c_custkey%5=0  THEN cast(c_custkey AS {text})
       WHEN c_custkey%3=0  THEN 'u'||cast(c_custkey AS {text})||'@a@b'
       WHEN c_custkey%2=0  THEN '@x'
       ELSE c_name||'@mail.example' END AS mail,
  CASE WHEN c_custkey%11=0 THEN NULL WHEN c_custkey%7=0 THEN ''
       WHEN c_custkey%5=0  THEN lpad(cast(c_custkey AS {text}),15,'1')
       WHEN c_custkey%3=0  THEN lpad(cast(c_custkey AS {text}),17,'2')||'x'
       WHEN c_custkey%2=0  THEN lpad(cast(c_custkey AS {text}),17,'3')||'X'
       ELSE lpad(cast(c_custkey AS {text}),18,'4') END AS id_card
FROM {customer}
"""

STATEFUL_ORDERS = """
SELECT *,
  CASE o_orderkey%4 WHEN 0 THEN {timestamp} '2100-01-01 00:00:00'
                    WHEN 1 THEN NULL
                    WHEN 2 THEN {timestamp} '2024-01-01 00:00:00'
                    ELSE {timestamp} '2200-01-01 00:00:00' END AS jcsjc,
  CASE WHEN o_orderkey%5=0 THEN NULL WHEN o_orderkey%7=0 THEN ''
       ELSE o_orderpriority END AS checked
FROM {orders}
"""

# Texts that a CSV file has to keep: line ends, outer blanks, backslashes, quotes, the
# marker of NULL, the empty text.
HARD_TEXT = """CASE id % 9
  WHEN 0 THEN 'a' || chr(10) || 'b' WHEN 1 THEN chr(13) || 'x' || chr(13) || chr(10)
  WHEN 2 THEN '  lead and trail  ' WHEN 3 THEN chr(92) || 'N' WHEN 4 THEN chr(92) || 'n' || chr(92)
  WHEN 5 THEN chr(34) || 'q' || chr(34) || ' ' WHEN 6 THEN NULL WHEN 7 THEN ''
  ELSE chr(92) || '-' || name END"""

DUCK_DIRTY_CUSTOMER = DIRTY_CUSTOMER.format(text="varchar", customer="customer")
DUCK_STATEFUL_ORDERS = STATEFUL_ORDERS.format(timestamp="timestamp", orders="orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = DIRTY_CUSTOMER.format(text="string", customer="{customer}")
    return spark.sql(sql, customer=table(spark, sf_dir, "customer"))


def stateful_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = STATEFUL_ORDERS.format(timestamp="timestamp_ntz", orders="{orders}")
    return spark.sql(sql, orders=table(spark, sf_dir, "orders"))


def graded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality label; NULL where there is none."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left")
