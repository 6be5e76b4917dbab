"""Facts about the running session: where scratch data may go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def is_single_process(spark: SparkSession) -> bool:
    """Driver and executors share one process (``local[...]``)."""
    return re.match(r"local(\[|$)", spark.conf.get("spark.master", "")) is not None


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share.

    On a cluster it has to be set; a machine-local folder is used only where
    driver and executors are one process.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not is_single_process(spark):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/tablecheck-{uuid.uuid4().hex}/{name}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``scratch_path`` that is no longer needed."""
    if not re.search(r"/tablecheck-[0-9a-f]{32}/[^/]+$", path):
        raise ValueError(f"not a scratch path: {path}")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
