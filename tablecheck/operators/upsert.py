"""Keyed update of one table by another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.session import drop_scratch, scratch_path


def upsert_by_key(target: DataFrame, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target rows whose key is not in ``updates``, and all of ``updates``.

    ``updates`` holds one row per key. Only its keys are matched, made distinct
    before the shuffle, so a hot key in ``updates`` costs nothing; the join is
    broadcast only where the optimizer knows that side to be small, and a hot key
    in ``target`` is split by the adaptive skew join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def upsert_partitions(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str | Sequence[str],
    partition: str,
) -> list:
    """Update and insert rows by key in a table of files, rewriting only the partitions that
    hold an updated key or get a row; the files of all others stay as they are.

    ``updates`` has all columns and one row per key; a new value of ``partition`` moves the
    row. Key and partition of the table are read once to find those partitions, whose values
    pass the driver, as the list of folders does when a table is read. The new rows are
    staged first, since they are made of what they replace. A run that failed half-way is
    mended by running it again. Returns the values of the partitions that were rewritten.
    """
    keys = [key] if isinstance(key, str) else list(key)
    scratch = scratch_path(spark, "upsert")
    try:
        updates.write.parquet(f"{scratch}/updates")
        changes = spark.read.schema(updates.schema).parquet(f"{scratch}/updates")
        table = spark.read.schema(updates.schema).parquet(path)
        ids = changes.select(*keys).distinct()
        held = table.select(*keys, partition).join(ids, keys, "left_semi").select(partition)
        found = held.unionByName(changes.select(partition)).distinct().collect()
        touched = [r[0] for r in found]
        known = F.col(partition).isin([v for v in touched if v is not None])
        old = table.where(known | F.col(partition).isNull() if None in touched else known)
        rows = upsert_by_key(old, changes, keys)
        rows.write.parquet(f"{scratch}/rows")
        staged = spark.read.schema(updates.schema).parquet(f"{scratch}/rows")
        # files of even size, a large partition in several
        dealt = staged.hint("rebalance", partition)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition).parquet(path)
        left = {r[0] for r in staged.select(partition).distinct().collect()}
        for value in touched:
            if value not in left:
                _drop_partition(spark, path, partition, value)
        return touched
    finally:
        drop_scratch(spark, scratch)


def _drop_partition(spark: SparkSession, path: str, partition: str, value: object) -> None:
    """Delete the folder of a partition that has no rows any more."""
    jvm = spark._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = names.DEFAULT_PARTITION_NAME() if value is None else str(value)
    name = names.getPartitionPathString(partition, text)
    folder = jvm.org.apache.hadoop.fs.Path(path, name)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
