"""Winnowed anchors: what both operators on repeated passages start from.

An anchor is the run with the smallest hash among all runs inside a window; equal ones
count by the rightmost. So equal windows have their anchor at the same place, wherever
they are, and a window that repeats anywhere shares its anchor's hash with another place.
An anchor's context is all that its windows can reach; equal contexts mean that every
window in them repeats.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.session import scratch_path

#: More identifiers than this are matched with the texts by a shuffle (8 bytes each).
MOST_BROADCAST = 2_000_000

ANCHORS = "hash long, context long, doc long, place int"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the folder all executors share."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` run hashes, the place of its anchor."""
    count = len(hashes)
    if count < width:
        return np.empty(0, np.int64)
    # the place, counted from the right, decides between equal hashes
    bits = np.uint64(max(1, int(count).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (hashes & ~low) | (low - np.arange(count, dtype=np.uint64))
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return (low - (least & low)).astype(np.int64)


def shared(anchors: DataFrame, hashes: DataFrame) -> DataFrame:
    """Anchors whose hash comes more than once. ``hashes`` has the column ``hash`` only.

    The counts are written first: only a join of two plain shuffles can be split where one
    hash has a large part of the rows.
    """
    counts = hashes.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    return anchors.join(written(counts, "counts"), "hash")


def split_touched(documents: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ``documents`` (doc, text) with an identifier in ``ids`` (doc), and the others.

    The others are None if there are too many identifiers to send to every task; then the
    first part is all rows, and a join with them is a shuffle of all texts.
    """
    if ids.count() > MOST_BROADCAST:
        return documents, None
    side = F.broadcast(ids)
    return documents.join(side, "doc", "left_semi"), documents.join(side, "doc", "left_anti")


def merged_spans(starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Union of spans as rows (start, end), clipped to ``length``."""
    starts, ends = np.clip(starts, 0, length), np.clip(ends, 0, length)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    if not len(starts):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    spans = np.stack([starts[new], np.maximum.reduceat(ends, new)], axis=1)
    return spans[spans[:, 1] > spans[:, 0]]
