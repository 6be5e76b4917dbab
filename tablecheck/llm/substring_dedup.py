"""Exact substring deduplication of words by seed and extend.

Documents are joined on the hashes of winnowed anchors (seeds of ``SEED`` words). A seed
is extended both ways as far as a window of ``WINDOW`` words around it reaches. Where the
whole extension equals one in an earlier document, all of it is a repeat. Where documents
share a seed but not its whole extension, the extensions of window length are compared
one by one: each is looked up by its hash, and the smallest document that has it keeps
it. Neighbouring windows join into maximal repeats; repeats inside one document are found
when its text is read for the last time.

Only hashes and places are shuffled until then: a passage that a third of the corpus
shares is aggregated before it travels, and its extensions are spread by their own hashes.

Rules for odd input: NULL and empty texts have no words; texts shorter than a window lose
nothing; of equal windows the one in the smallest identifier, then the first, stays; rows
that repeat an identifier count as one document, and what is found in any of them is
removed from each; rows with a NULL identifier are returned whole; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.repeats import (
    ANCHORS,
    merged_spans,
    shared,
    split_touched,
    window_anchors,
    written,
)
from tablecheck.llm.words import STEP, WordHashes, mixed, run_hashes, split_words

WINDOW = 20
SEED = 6
#: Seeds that begin inside one window.
WIDTH = WINDOW - SEED + 1
#: Words of texts that are hashed together.
CHUNK_WORDS = 150_000


class Chunk:
    """Words of several texts in one array, parted by zeros that no window spans.

    A word's hash is never zero in practice; zeros are what a context sees beyond an end.
    """

    def __init__(self, hashes: WordHashes, texts: list[list[bytes]]):
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.begins = WINDOW + np.r_[0, np.cumsum(self.lengths + WINDOW)[:-1]]
        size = int(self.begins[-1] + self.lengths[-1]) + 2 * WINDOW
        self.words = np.zeros(size, np.uint64)
        for words, begin in zip(texts, self.begins):
            self.words[begin : begin + len(words)] = hashes.of(words)
        counts = np.maximum(self.lengths - WINDOW + 1, 0)
        #: The text, and the place in ``words``, of every window.
        self.owner = np.repeat(np.arange(len(texts)), counts)
        inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        self.windows = self.begins[self.owner] + inside

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Seed hash of every place, and the place of every window's anchor."""
        seeds = run_hashes(self.words, SEED)
        return seeds, window_anchors(seeds, WIDTH)[self.windows]

    def anchors(self) -> tuple[np.ndarray, ...]:
        """Text, seed hash, context hash and place of the first anchor of each kind."""
        seeds, chosen = self.seeds()
        places, first = np.unique(chosen, return_index=True)
        owner, hashes = self.owner[first], seeds[places]
        # the words that the windows of an anchor can reach
        contexts = hashes_at(self.words, places - (WINDOW - SEED), 2 * WINDOW - SEED)
        kind = mixed(mixed(hashes) + contexts + owner.astype(np.uint64) * np.uint64(STEP))
        _, kept = np.unique(kind, return_index=True)
        return owner[kept], hashes[kept], contexts[kept], (places - self.begins[owner])[kept]

    def inner_repeats(self) -> list[np.ndarray]:
        """For each text, starts of the windows that also start earlier in it."""
        hashes = hashes_at(self.words, self.windows, WINDOW)
        order = np.argsort(hashes, kind="stable")
        owner = self.owner[order]
        same = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[1:] == owner[:-1])
        later = np.sort(order[1:][same])
        cuts = np.searchsorted(self.owner[later], np.arange(1, len(self.lengths)))
        starts = self.windows[later] - self.begins[self.owner[later]]
        return np.split(starts, cuts)


def chunks(texts: list[str | None]) -> Iterator[tuple[slice, list[list[bytes]]]]:
    """Words of the texts, in groups of some size."""
    group, size, begin = [], 0, 0
    for number, text in enumerate(texts):
        group.append(split_words(text))
        size += len(group[-1])
        if size >= CHUNK_WORDS:
            yield slice(begin, number + 1), group
            group, size, begin = [], 0, number + 1
    if group:
        yield slice(begin, len(texts)), group


def hashes_at(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Hash of the run of ``length`` words at each place."""
    total = np.full(len(places), 0x5851F42D4C957F2D, np.uint64)
    for i in range(length):
        total = (total ^ words[places + i]) * np.uint64(0x9FB21C651E98DF25)
        total ^= total >> np.uint64(32)
    return mixed(total)


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))


def _anchor_rows(texts: DataFrame, only_hashes: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for part, words in chunks(batch.column(1).to_pylist()):
                owner, hashes, contexts, places = Chunk(memory, words).anchors()
                columns = [
                    pa.array(hashes.view(np.int64)),
                    pa.array(contexts.view(np.int64)),
                    pa.array(docs[part][owner]),
                    pa.array(places.astype(np.int32)),
                ]
                names = ["hash", "context", "doc", "place"]
                count = 1 if only_hashes else len(names)
                yield pa.RecordBatch.from_arrays(columns[:count], names[:count])

    return texts.mapInArrow(run, "hash long" if only_hashes else ANCHORS)


def _extensions(texts: DataFrame) -> DataFrame:
    """Two hashes and the place of every window of the anchors listed in ``places``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordHashes()
        for batch in batches:
            docs, listed = batch["doc"].to_numpy(), batch["places"].to_list()
            for part, words in chunks(batch["text"].to_list()):
                chunk = Chunk(memory, words)
                wanted = [b + np.asarray(x) for b, x in zip(chunk.begins, listed[part])]
                _, chosen = chunk.seeds()
                at = np.flatnonzero(np.isin(chosen, np.concatenate(wanted)))
                owner, places = chunk.owner[at], chunk.windows[at]
                yield pd.DataFrame(
                    {
                        "key1": hashes_at(chunk.words, places, WINDOW).view(np.int64),
                        "key2": hashes_at(mixed(chunk.words), places, WINDOW).view(np.int64),
                        "doc": docs[part][owner],
                        "place": (places - chunk.begins[owner]).astype(np.int32),
                    }
                )

    return texts.mapInPandas(run, "key1 long, key2 long, doc long, place int")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, start, end) in words: what also stands in a document with a smaller identifier."""
    known = texts.where("doc IS NOT NULL")
    anchors = shared(_anchor_rows(known, False), _anchor_rows(known, True))
    anchors = written(anchors, "anchors")
    firsts = anchors.groupBy("hash", "context").agg(F.min("doc").alias("first"))
    firsts = written(firsts, "firsts")
    variants = firsts.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    variants = written(variants, "variants")
    marked = anchors.join(firsts, ["hash", "context"])
    repeats = marked.where("doc > first").select(
        "doc",
        (F.col("place") - (WINDOW - SEED)).alias("start"),
        (F.col("place") + WINDOW).alias("end"),
    )
    # seeds in several surroundings: compare their windows one by one
    open_ = marked.where("doc = first").select("hash", "doc", "place").join(variants, "hash")
    by_doc = open_.groupBy("doc").agg(F.collect_list("place").alias("places"))
    by_doc = written(by_doc, "open")
    near, _ = split_touched(known, by_doc.select("doc"))
    windows = written(_extensions(near.join(by_doc, "doc")), "windows")
    owners = windows.groupBy("key1", "key2").agg(F.min("doc").alias("first"), F.max("doc").alias("d"))
    owners = written(owners.where("first < d").drop("d"), "owners")
    later = windows.join(owners, ["key1", "key2"]).where("doc > first")
    return repeats.unionByName(
        later.select("doc", F.col("place").alias("start"), (F.col("place") + WINDOW).alias("end"))
    )


def _without(words: list[bytes], own: np.ndarray, starts, ends) -> list[bytes]:
    """Words outside the repeats found here (``own``) and in earlier documents."""
    first, last = own, own + WINDOW
    if starts is not None:
        first = np.concatenate([first, np.asarray(starts, np.int64)])
        last = np.concatenate([last, np.asarray(ends, np.int64)])
    kept, at = [], 0
    for start, end in merged_spans(first, last, len(words)):
        kept += words[at:start]
        at = end
    return kept + words[at:]


def remove_repeats(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc, n_words, n_removed, kept): every text without its repeated words.

    ``kept`` joins what is left by single spaces; ``n_removed`` counts words.
    """
    texts = _texts(df, id_column, text_column)
    spans = repeated_spans(texts)
    spans = spans.groupBy("doc").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    spans = written(spans, "spans")
    touched, untouched = split_touched(texts, spans.select("doc"))
    joined = touched.join(spans, "doc", "left")
    if untouched is not None:
        joined = joined.unionByName(untouched, allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordHashes()
        for batch in batches:
            rows = []
            listed = list(zip(batch["doc"], batch["starts"], batch["ends"]))
            for part, texts in chunks(batch["text"].to_list()):
                inner = Chunk(memory, texts).inner_repeats()
                for (doc, starts, ends), words, own in zip(listed[part], texts, inner):
                    kept = words
                    if len(own) or starts is not None:
                        kept = _without(words, own, starts, ends)
                    row = (doc, len(words), len(words) - len(kept), b" ".join(kept).decode())
                    rows.append(row)
            frame = pd.DataFrame(rows, columns=["doc", "n_words", "n_removed", "kept"])
            yield frame.astype({"doc": "Int64"})

    return joined.mapInPandas(run, "doc long, n_words long, n_removed long, kept string")
