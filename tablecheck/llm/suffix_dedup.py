"""Exact substring deduplication of bytes with suffix arrays.

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else is removed,
all copies alike.

1. Winnowed anchors name the places where a repeat is possible: a string that stands in
   two places has its anchor's hash in both. Anchors whose hash comes once are done.
2. The windows that have an anchor in common make a block. Where a whole block comes more
   than once, all of it repeats; copies of documents end here, as hashes.
3. Where an anchor has several blocks, the bytes of one copy of each go to shards by its
   hash. Each shard gets a suffix array by Larsson-Sadakane refinement and Kasai's common
   prefixes; windows that share ``WINDOW`` bytes with a neighbour repeat.
4. An anchor with more blocks than ``PIECE`` is spread over shards by their hash. Such
   shards hand on one digest for each of their different windows; these lists are dealt by
   digest, and each is looked up in the union of all by binary search.

Rules for odd input: NULL and empty texts have no bytes; texts shorter than a window lose
nothing; matches never cross documents; rows that repeat an identifier are texts like any
others, copies of each other where they are equal; rows with a NULL identifier are returned
whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.repeats import (
    merged_spans,
    shared,
    split_touched,
    window_anchors,
    written,
)
from tablecheck.llm.suffix_array import common_prefixes, suffix_array
from tablecheck.llm.words import STEP, mixed

WINDOW = 200
SEED = 64
#: Seeds that begin inside one window.
WIDTH = WINDOW - SEED + 1
#: Bytes of texts that are hashed together.
CHUNK_BYTES = 400_000
#: Bytes of one suffix array; a group of blocks is never cut, so some are larger.
SHARD_BYTES = 1_000_000
#: Blocks of one anchor that go to one shard.
PIECE = 2_048

_random = np.random.default_rng(20240611)
#: A random number for every byte value; zero is what lies beyond a text.
VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    up, down = np.full(size, STEP, np.uint64), np.full(size, pow(STEP, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Chunk:
    """Bytes of several texts, parted by gaps that no window spans."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.begins = WINDOW + np.r_[0, np.cumsum(self.lengths + WINDOW)[:-1]]
        gap = bytes(WINDOW)
        joined = gap + b"".join(x + gap for x in texts)
        values = VALUES[np.frombuffer(joined, np.uint8)]
        for begin, length in zip(self.begins, self.lengths):
            values[begin + length : begin + length + WINDOW] = 0
        values[:WINDOW] = 0
        size = len(values)
        up, self.down = _powers(1 << size.bit_length())
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values * up[:size], out=self.sums[1:])
        counts = np.maximum(self.lengths - WINDOW + 1, 0)
        self.owner = np.repeat(np.arange(len(texts)), counts)
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        self.windows = self.begins[self.owner] + inside

    def hashes(self, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hash of so many bytes at each start."""
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.down[starts])

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Seed hash of every place, and the place of every window's anchor."""
        count = len(self.sums) - SEED
        seeds = mixed((self.sums[SEED:] - self.sums[:-SEED]) * self.down[:count])
        return seeds, window_anchors(seeds, WIDTH)[self.windows]

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Text, seed hash, block hash, start and end of the block of every anchor."""
        seeds, chosen = self.seeds()
        if not len(chosen):
            return (np.empty(0, np.int64), *[np.empty(0, np.uint64)] * 2, *[np.empty(0, np.int64)] * 2)
        # anchors move to the right with their windows
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        last = np.r_[first[1:], len(chosen)] - 1
        places, owner = chosen[first], self.owner[first]
        starts, ends = self.windows[first], self.windows[last] + WINDOW
        shape = (places - starts).astype(np.uint64) << np.uint64(32) | (ends - starts).astype(np.uint64)
        blocks = mixed(self.hashes(starts, ends - starts) ^ mixed(shape))
        return owner, seeds[places], blocks, starts - self.begins[owner], ends - self.begins[owner]


def chunks(texts: list[bytes]) -> Iterator[slice]:
    """Texts in groups of some size."""
    size, begin = 0, 0
    for number, text in enumerate(texts):
        size += len(text) + WINDOW
        if size >= CHUNK_BYTES:
            yield slice(begin, number + 1)
            size, begin = 0, number + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text, doc): ``doc`` stands for an identifier and its text, so that another text of
    the same identifier is another one; equal rows share it."""
    data = F.coalesce(F.col(text_column).cast("string").cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_column).cast("long").alias("id"), data.alias("text"))
    return rows.withColumn("doc", F.when(F.col("id").isNotNull(), F.xxhash64("id", "text")))


ANCHORS = "hash long, block long, doc long, start int, end int"


def _anchor_rows(texts: DataFrame, only_hashes: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, data = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for part in chunks(data):
                owner, hashes, blocks, starts, ends = Chunk(data[part]).anchors()
                columns = [
                    pa.array(hashes.view(np.int64)),
                    pa.array(blocks.view(np.int64)),
                    pa.array(docs[part][owner]),
                    pa.array(starts.astype(np.int32)),
                    pa.array(ends.astype(np.int32)),
                ]
                names = ["hash", "block", "doc", "start", "end"]
                count = 1 if only_hashes else len(names)
                yield pa.RecordBatch.from_arrays(columns[:count], names[:count])

    chosen = texts.select("doc", "text")
    return chosen.mapInArrow(run, "hash long" if only_hashes else ANCHORS)


FOUND = "doc long, start int, end int, key1 long, key2 long, alone boolean"


def _window_classes(data: np.ndarray) -> np.ndarray:
    """For every place a number that places with the same ``WINDOW`` bytes share."""
    order = suffix_array(data)
    prefixes = common_prefixes(data, order, WINDOW)
    classes = np.empty(len(data), np.int32)
    classes[order] = np.cumsum(prefixes < WINDOW)
    return classes


def _shard(blocks: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of one shard, as spans, and digests for the merge of split groups."""
    data = np.frombuffer(b"".join(blocks["data"]), np.uint8)
    lengths = blocks["data"].str.len().to_numpy()
    begins = np.cumsum(lengths) - lengths
    counts = lengths - WINDOW + 1
    # the largest arrays come and go before those of the windows are made
    own = _window_classes(data)
    owner = np.repeat(np.arange(len(blocks), dtype=np.int32), counts)
    inside = np.arange(len(owner), dtype=np.int32)
    inside -= np.repeat((np.cumsum(counts) - counts).astype(np.int32), counts)
    windows = begins.astype(np.int32)[owner] + inside
    own = own[windows]
    repeated = np.bincount(own, minlength=len(data) + 1)[own] > 1

    alone = blocks["alone"].to_numpy(bool)[owner]
    docs = blocks["doc"].to_numpy()[owner]
    places = blocks["start"].to_numpy()[owner] + inside
    hit = np.flatnonzero(repeated & alone)
    parts = []
    if len(hit):
        new = np.flatnonzero(np.r_[True, (np.diff(hit) > 1) | (np.diff(owner[hit]) > 0)])
        last = hit[np.r_[new[1:], len(hit)] - 1]
        frame = {"doc": docs[hit[new]], "start": places[hit[new]], "end": places[last] + WINDOW}
        parts.append(pd.DataFrame(frame).assign(key1=0, key2=0, alone=False))
    split = np.flatnonzero(blocks["pieces"].to_numpy()[owner] > 1)
    if len(split):
        _, first = np.unique(own[split], return_index=True)
        pick = split[first]
        raw = data.tobytes()
        digests = b"".join(xxhash.xxh3_128_digest(raw[i : i + WINDOW]) for i in windows[pick])
        keys = np.frombuffer(digests, "<i8").reshape(-1, 2)
        frame = {"doc": docs[pick], "start": places[pick], "end": 0, "key1": keys[:, 0]}
        frame |= {"key2": keys[:, 1], "alone": alone[pick] & ~repeated[pick]}
        parts.append(pd.DataFrame(frame))
    names = [x.split()[0] for x in FOUND.split(", ")]
    if not parts:
        return pd.DataFrame({x: [] for x in names})
    # end 0 marks a digest for the merge
    return pd.concat(parts)[names]


def _sort_shards(blocks: DataFrame) -> DataFrame:
    """Shards of whole groups, one after another in every task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            group = batch["hash"].ne(batch["hash"].shift()) | batch["piece"].ne(batch["piece"].shift())
            starts = np.flatnonzero(group.to_numpy())
            for i, j in zip(starts, np.r_[starts[1:], len(batch)]):
                part = batch.iloc[i:j]
                key = (part["hash"].iloc[0], part["piece"].iloc[0])
                if size >= SHARD_BYTES and key != held[-1][0]:
                    yield _shard(pd.concat([x for _, x in held]))
                    held, size = [], 0
                held.append((key, part))
                size += int(part["data"].str.len().sum())
        if held:
            yield _shard(pd.concat([x for _, x in held]))

    dealt = blocks.repartition("hash", "piece").sortWithinPartitions("hash", "piece")
    return dealt.mapInPandas(run, FOUND)


def _merge_shards(digests: DataFrame) -> DataFrame:
    """Windows that no other in their shard equals, but one in another shard does."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # without an empty frame among them, which would turn whole numbers into floats
        parts = [batch for batch in batches if len(batch)]
        if not parts:
            return
        rows = pd.concat(parts)
        keys = np.empty(len(rows), [("a", "<i8"), ("b", "<i8")])
        keys["a"], keys["b"] = rows["key1"].to_numpy("i8"), rows["key2"].to_numpy("i8")
        merged = np.sort(keys)
        count = np.searchsorted(merged, keys, "right") - np.searchsorted(merged, keys, "left")
        hit = rows[(count > 1) & rows["alone"].to_numpy(bool)]
        yield hit.assign(end=hit["start"] + WINDOW)[["doc", "start", "end"]]

    return digests.repartition("key1", "key2").mapInPandas(run, "doc long, start int, end int")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, start, end) in bytes of what also starts elsewhere; spans may overlap."""
    known = texts.where("doc IS NOT NULL")
    anchors = written(shared(_anchor_rows(known, False), _anchor_rows(known, True)), "anchors")
    groups = anchors.groupBy("hash", "block").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "start", "end")).alias("one")
    )
    groups = written(groups, "groups")
    variants = groups.groupBy("hash").agg(F.count("*").alias("variants")).where("variants > 1")
    variants = written(variants, "variants")
    several = groups.where("n > 1").select("hash", "block")
    spans = anchors.join(several, ["hash", "block"]).select("doc", "start", "end")
    # of equal blocks one stands for all
    chosen = groups.join(variants, "hash").select("hash", "block", "n", "variants", "one.*")
    pieces = F.ceil(F.col("variants") / PIECE).cast("int")
    open_ = chosen.select(
        "doc",
        F.struct(
            "start",
            "end",
            "hash",
            F.pmod("block", pieces).cast("int").alias("piece"),
            pieces.alias("pieces"),
            (F.col("n") == 1).alias("alone"),
        ).alias("open"),
    )
    by_doc = written(open_.groupBy("doc").agg(F.collect_list("open").alias("open")), "open")
    near, _ = split_touched(known, by_doc.select("doc"))
    # equal rows have one text
    once = near.select("doc", "text").join(by_doc, "doc").dropDuplicates(["doc"])
    cut = once.select("doc", "text", F.explode("open").alias("open"))
    length = F.col("open.end") - F.col("open.start")
    data = F.substring(F.col("text"), F.col("open.start") + 1, length)
    blocks = cut.select(
        "open.hash", "open.piece", "open.pieces", "open.alone", "doc", "open.start", data.alias("data")
    )
    found = written(_sort_shards(blocks), "found")
    merged = _merge_shards(found.where("end = 0").drop("end").withColumn("end", F.lit(0)))
    spans = spans.unionByName(found.where("end > 0").select("doc", "start", "end"))
    return spans.unionByName(merged)


def whole_characters(spans: np.ndarray, data: bytes) -> np.ndarray:
    """Spans cut back to where characters begin, so that what is left is valid UTF-8."""
    cut = []
    for start, end in spans:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if end > start:
            cut.append((start, end))
    return np.array(cut, np.int64).reshape(-1, 2)


def remove_repeats(
    df: DataFrame, id_column: str, text_column: str, characters: bool = False
) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept, text_key): texts without repeated bytes.

    With ``characters`` a removed span ends at whole characters, so ``kept`` stays text.
    ``text_key`` is the hash of the whole text, to tell rows of one identifier apart.
    """
    texts = _texts(df, id_column, text_column)
    spans = repeated_spans(texts).groupBy("doc").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    spans = written(spans, "spans")
    touched, untouched = split_touched(texts, spans.select("doc"))
    key = F.xxhash64("text").alias("text_key")
    joined = touched.join(spans, "doc", "left").select("id", "text", "starts", "ends", key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            columns = (batch[c] for c in ("id", "text", "starts", "ends", "text_key"))
            for doc, data, starts, ends, key in zip(*columns):
                starts, ends = ((() if x is None else x) for x in (starts, ends))
                own = merged_spans(np.asarray(starts, np.int64), np.asarray(ends, np.int64), len(data))
                own = whole_characters(own, data) if characters else own
                kept, at = [], 0
                for start, end in own:
                    kept.append(data[at:start])
                    at = end
                left = b"".join([*kept, data[at:]])
                rows.append((doc, len(data), len(data) - len(left), len(own), left, key))
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept", "text_key"]
            yield pd.DataFrame(rows, columns=names).astype({"doc": "Int64"})

    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept binary, text_key long"
    removed = joined.mapInPandas(run, schema)
    if untouched is None:
        return removed
    zero = F.lit(0).cast("long")
    return removed.unionByName(
        untouched.select(
            F.col("id").alias("doc"),
            F.octet_length("text").cast("long").alias("n_bytes"),
            zero.alias("n_removed"),
            zero.alias("n_spans"),
            F.col("text").alias("kept"),
            F.xxhash64("text").alias("text_key"),
        )
    )
