"""Connected components of a table of links, by large and small stars.

Before the stars each task replaces the links it holds, block by block, by those of a forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import written

#: Links of a block, which a task contracts at once.
LINKS_A_BLOCK = 100_000


def _contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that tie every node to the smallest one that it reaches by the links given."""
    names, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(names))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, up := root[root]):
            root = up
        a, b = root[a], root[b]
        open_ = a != b
        a, b = a[open_], b[open_]
    tied = np.flatnonzero(root != np.arange(len(names)))
    return names[tied], names[root[tied]]


def _forests(edges: DataFrame) -> DataFrame:
    """Links (u, v) with the same components, fewer than the nodes of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= LINKS_A_BLOCK:
                yield contracted(held)
                held, rows = [], 0
        if rows:
            yield contracted(held)

    def contracted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(held)
        ends = _contracted(block.column("u").to_numpy(), block.column("v").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def _star(edges: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Both directions of all edges, and the smallest neighbour (or self) of each node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    # written first, so that the join can be split where one node has a large part of the links
    return both, written(least.select("u", F.least("u", "least").alias("least")), 2 * count)


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Every larger neighbour is tied to the smallest in reach."""
    both, least = _star(edges, count)
    tied = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), "least")
    return tied.select("u", F.col("least").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("least")), count)
    tied = down.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return tied.unionByName(own).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (u, v) can reach.

    Nodes without a link are not in the result. Links of a single block are contracted at
    once. With more of them each round halves the depth of the stars at least, with one
    aggregation and one join for either star; joins on a centre with many links are split by
    the adaptive skew join. Ends when a round changes nothing.
    """
    edges = links.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    count = edges.count()
    blocks = max(1, ceil(count / LINKS_A_BLOCK))
    forests = _forests(edges.coalesce(blocks))
    if blocks == 1:
        return _named(written(forests))
    edges = written(forests.distinct(), count)
    before = None
    while True:
        edges = written(_large_star(edges, count), count)
        edges = written(_small_star(edges, count), count)
        state = edges.agg(
            F.count("*").alias("rows"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        ).first()
        if before == tuple(state):
            return _named(edges)
        before = tuple(state)


def _named(stars: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (node, smallest node)."""
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
