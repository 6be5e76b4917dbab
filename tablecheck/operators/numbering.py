"""Row numbers over a whole table without sorting it in one task.

``ROW_NUMBER() OVER (ORDER BY k)`` puts all rows into one task. Here Spark's range
shuffle deals the rows out in order, each partition sorts its part, and a row's number is
its place there plus the rows of the partitions before.

A random tie-break is part of the range key, so an order key that a large part of the
rows share, copies of whole rows included, is cut into many partitions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.session import scratch_path

TIE_SEED = 7
# ``monotonically_increasing_id`` holds the partition above so many bits of position.
POSITION_BITS = 33

#: Bytes of input for each partition of ordered rows, unless the session asks for more parts.
PARTITION_BYTES = 256 * 2**20

_TIE, _PLACE = "_tie", "_place"


def _input_bytes(df: DataFrame) -> int:
    """Bytes of what the plan reads, as far as its sources say."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 2**60)  # a source that does not know says more


def number_rows(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str = "rownum",
    *,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in ascending order of ``order_by``, NULL first.

    Rows with equal order keys get their numbers in any order. ``df`` is read twice, for
    the bounds of the partitions (order columns only) and for the shuffle into
    ``partitions`` (default: the session's number of shuffle partitions, or as many as the
    size of the input asks for, if that is more). The ordered
    rows are written to the shared folder, so that counts and numbers, and tasks that run
    again, agree on them; one count for each partition reaches the driver.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    columns, spark = df.columns, df.sparkSession
    taken = {name, _TIE, _PLACE}.intersection(columns)
    if taken:
        raise ValueError(f"column names that the numbering needs: {sorted(taken)}")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = partitions or max(usual, _input_bytes(df) // PARTITION_BYTES + 1)
    path = scratch_path(spark, "ordered")
    (
        df.withColumn(_TIE, F.rand(TIE_SEED))
        .repartitionByRange(number, *order, _TIE)
        .sortWithinPartitions(*order)
        .drop(_TIE)
        .withColumn(_PLACE, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    ordered = spark.read.parquet(path)
    partition = F.shiftright(_PLACE, POSITION_BITS).cast("int")
    counted = ordered.groupBy(partition.alias("part")).agg(F.count("*").alias("n")).collect()
    sizes = {r["part"]: r["n"] for r in counted}
    before = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0) + 1))]
    offsets = F.from_json(F.lit(json.dumps(before)), T.ArrayType(T.LongType()))
    position = F.col(_PLACE).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return ordered.select(*columns, (F.get(offsets, partition) + position + 1).alias(name))


def partition_bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of the partition column, and the row count."""
    return df.agg(
        F.min(column).alias("lower_bound"),
        F.max(column).alias("upper_bound"),
        F.count("*").alias("row_count"),
    )
