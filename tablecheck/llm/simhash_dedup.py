"""Near-duplicate documents by SimHash fingerprints and pivot distance tables.

A fingerprint has 64 bits; one is set if it is set in more than half of the XXH64 hashes
(seed 42) of the text's three-word shingles, repeats included. Fingerprints that differ in
at most two bits are linked.

A fixed list of ``REFERENCES`` reference fingerprints is the set of pivots. The distance table
of a fingerprint, its Hamming distance to each pivot, is computed once. By the triangle
inequality two fingerprints at distance d differ by at most d in every column of the table,
so a pair with a larger difference in any column is discarded, and only the survivors are
compared bit by bit.

Tables alone would leave all pairs to be looked at, so equal bits say which fingerprints meet:
64 bits in five blocks, of which two differing bits leave three untouched. Each choice of
three blocks is a grouping key (ten for each fingerprint). Groups of more than
``SMALL_GROUP`` members are dealt again by the same rule on the bits that still vary; then 53
bits are equal and at most 2,048 different fingerprints remain, so no group grows with the
data. Equal fingerprints are one member from the start. Of a group only a spanning forest of
its links leaves the task: components need no more, and no link between components is lost.

Rules for odd input: NULL, empty and blank texts have the fingerprint zero, which is linked
like any other; texts of one or two words are one shingle of that length; rows that repeat an
identifier get a result each and share the component of all its texts; rows with a NULL
identifier are left out; texts may be of any length; extra columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import staged
from tablecheck.llm.components import components

SHINGLE = 3
SEED = 42
MOST_DIFFERENT = 2
REFERENCES = 32
SMALL_GROUP = 1024
#: Blocks of the bits and how many of them are equal for certain.
BLOCKS, EQUAL = 5, 3
#: Shingles whose bits are counted at a time.
COUNTED = 65_536

PIVOTS = np.random.default_rng(20250101).integers(0, 2**64, REFERENCES, dtype=np.uint64)


def fingerprint(text: bytes | None) -> int:
    """64 bits of a text in UTF-8."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(SHINGLE, len(words))
    starts = np.r_[0, ends[:-1] + 1][: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), COUNTED):
        spans = zip(starts[at : at + COUNTED], stops[at : at + COUNTED])
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * total > len(starts)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def distance_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (rows) to the pivots (columns)."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS[None, :])


def fingerprint_table(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, print): the fingerprint of every document, as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py()) for text in batch.column(1)]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "print"])

    chosen = df.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("t")
    )
    return chosen.where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, print long")


def with_tables(prints: DataFrame) -> DataFrame:
    """(rep, print) with the distance table, a byte for each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = distance_table(batch.column("print").to_numpy().view(np.uint64))
            rows = pa.array([row.tobytes() for row in tables], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], ["rep", "print", "distances"])

    return prints.select("rep", "print").mapInArrow(run, "rep long, print long, distances binary")


def _masks(bits: list[int]) -> list[int]:
    """Which of ``bits`` are equal for certain, by choice of untouched blocks."""
    blocks = np.array_split(np.array(bits), BLOCKS)
    return [
        sum(1 << int(bit) for block in chosen for bit in block)
        for chosen in combinations(blocks, EQUAL)
    ]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


WHOLE = 2**64 - 1
FIRST = _masks(list(range(64)))
#: For each first choice the finer ones: the same rule on the bits it leaves open.
SECOND = [
    [first | finer for finer in _masks([b for b in range(64) if not first >> b & 1])]
    for first in FIRST
]


def _dealt(members: DataFrame, masks: Column) -> DataFrame:
    """One row for each member and mask; ``node`` is the mask and the bits under it."""
    rows = members.select("rep", "print", "distances", F.posexplode(masks).alias("choice", "mask"))
    bits = F.col("print").bitwiseAND(F.col("mask"))
    return rows.withColumn("node", F.struct("mask", bits.alias("bits")))


def group_links(
    reps: np.ndarray, prints: np.ndarray, tables: np.ndarray
) -> tuple[list[tuple[int, int]], int, int]:
    """Spanning forest of the links of a group; pairs looked at and pairs that survive."""
    parent = list(range(len(reps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    signed = tables.astype(np.int8)
    links, looked, survived = [], 0, 0
    for i in range(len(reps) - 1):
        # the difference of two distances has the parity of their pair's distance
        apart = np.abs(signed[i + 1 :] - signed[i]).max(axis=1)
        near = np.flatnonzero(apart <= MOST_DIFFERENT) + i + 1
        looked, survived = looked + len(apart), survived + len(near)
        for j in near[np.bitwise_count(prints[near] ^ prints[i]) <= MOST_DIFFERENT].tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                links.append((int(reps[i]), int(reps[j])))
    return links, looked, survived


def _compared(members: DataFrame) -> DataFrame:
    """Links inside every group; members arrive group by group."""

    def links_of(held: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        table = pa.Table.from_batches(held)
        reps, prints = (table.column(c).to_numpy() for c in ("rep", "print"))
        rows = b"".join(table.column("distances").to_pylist())
        tables = np.frombuffer(rows, np.uint8).reshape(-1, REFERENCES)
        return group_links(reps, prints.view(np.uint64), tables)[0]

    def packed(links: list[tuple[int, int]]) -> pa.RecordBatch:
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            masks, bits = batch.column("mask").to_numpy(), batch.column("bits").to_numpy()
            new = np.flatnonzero((masks[1:] != masks[:-1]) | (bits[1:] != bits[:-1])) + 1
            links = []
            for a, b in zip(np.r_[0, new].tolist(), np.r_[new, len(masks)].tolist()):
                if a == b:
                    continue
                if held and last != (masks[a], bits[a]):
                    links += links_of(held)
                    held = []
                last = masks[a], bits[a]
                held.append(batch.slice(a, b - a))
            if links:
                yield packed(links)
        if held:
            yield packed(links_of(held))

    plain = members.select("node.mask", "node.bits", "rep", "print", "distances")
    dealt = plain.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "rep")
    return dealt.mapInArrow(run, "u long, v long")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of the groups of two and more, with the number of members."""
    # staged, so that the join can be split where one group has a large part of the rows
    sizes = staged(rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"))
    return rows.join(sizes.hint("merge"), "node")


def links(prints: DataFrame) -> DataFrame:
    """(u, v): links that hold every component of (rep, print) together; prints are distinct."""
    tables = staged(with_tables(prints))
    first = F.array(*[F.lit(_signed(m)) for m in FIRST])
    coarse = staged(_sized(_dealt(tables, first)))
    small = _compared(coarse.where(F.col("size") <= SMALL_GROUP))
    finer = F.array(*[F.array(*[F.lit(_signed(m)) for m in masks]) for masks in SECOND])
    large = coarse.where(F.col("size") > SMALL_GROUP)
    again = large.select("rep", "print", "distances", F.get(finer, F.col("choice")).alias("masks"))
    # masks of different first choices may be the same
    fine = _dealt(again, F.col("masks")).drop("choice").distinct()
    return small.unionByName(_compared(_sized(fine))).distinct()


def near_duplicates(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    documents = staged(fingerprint_table(df, id_column, text_column))
    classes = staged(documents.groupBy("print").agg(F.min("doc_id").alias("rep")))
    found = links(classes)
    # an identifier with several texts ties their classes together
    own = documents.join(classes.hint("merge"), "print")
    tied = own.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("w"))
    doubled = own.join(tied.where("u < w").hint("merge"), "doc_id")
    extra = doubled.selectExpr("u", "rep AS v").where("u <> v").distinct()
    labels = components(staged(found.unionByName(extra)))
    label = F.coalesce("component", "rep").alias("component_id")
    classes = classes.join(labels.hint("merge"), F.col("rep") == F.col("node"), "left")
    classes = classes.select("print", label)
    hex_print = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return documents.join(classes.hint("merge"), "print").select("doc_id", hex_print, "component_id")
