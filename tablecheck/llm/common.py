"""What several operators share: tables, staging and white space."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.session import scratch_path, scratch_root

#: Fixed value: the characters that separate words, space and \t to \r.
SPACES = " \t\n\v\f\r"
#: Rows of a table that are worth a file of their own.
ROWS_A_FILE = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """The rows, written to the folder all executors share and cut from their lineage.

    Spark deletes the files when nothing refers to them any more.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, rows: int | None = None, each: int = ROWS_A_FILE) -> DataFrame:
    """The rows as a table in the folder all executors share.

    ``rows``: about how many there are at most. Tasks of the last step take several partitions
    where these would be of fewer than ``each`` rows, down to one task for each core: in a loop
    over small tables a file for each partition takes longer than the rows do.

    Unlike a checkpoint, a table has a size of its own. What a checkpoint says of its size is
    the product of all the tables joined so far, and in a loop of joins that number doubles its
    digits each time until planning does nothing but multiply.
    """
    if rows is not None:
        cores = df.sparkSession.sparkContext.defaultParallelism
        df = df.coalesce(max(cores, ceil(rows / each)))
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: str):
    """UTF-8 bytes of a text column, empty for NULL."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))
