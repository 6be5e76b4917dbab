"""Benchmark decontamination by spaced seeds.

A seed is the hash of the tokens that a fixed mask selects from a short span; positions
the mask leaves out may differ. Seeds of the test items are joined with those of the
corpus, and at every hit the item is laid over the document at that offset: where enough
of ``WINDOW`` neighbouring tokens agree, the overlap is confirmed. Tokens are lower-case
words between white space and ASCII punctuation.

All masks begin with the same tokens, so a place of the corpus is first looked up by
these alone, and only the few that pass are hashed with every mask. Lookups are joins
with broadcast tables of a bounded number of seeds, taken in blocks if there are more: no
text is shuffled to find hits. Hits are made distinct as (document, item, offset), and a
second scan lays the items over the documents that have any.

Rules for odd input: NULL and empty texts have no tokens and no overlap; items with fewer
tokens than the shortest mask cannot be found; equal items are each reported; documents
that repeat an identifier are reported once for it, at the best of their places; rows
and items with a NULL identifier are left out; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import staged

#: Six tokens count; a mask with a hole fits over a substitution in every fourth or fifth
#: place. All begin with ``PREFIX`` tokens that count.
MASKS = ("111111", "1111011", "1110111", "11101011")
PREFIX = 3
#: An overlap is confirmed if this many of so many neighbouring tokens are equal. Items
#: that are shorter than the window need the same share of their tokens.
WINDOW = 16
LEAST_EQUAL = 12
#: Seeds in one broadcast table at most (some 30 bytes each).
BLOCK_SEEDS = 500_000
#: More hits than this are joined with the documents by a shuffle (some 50 bytes each).
MOST_BROADCAST = 500_000

#: Everything of ASCII but letters and digits parts tokens.
BREAK = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def tokens(text: Column) -> Column:
    value = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.array_remove(F.split(value, BREAK), "")


def _shifted(column: str, masks: tuple[str, ...]) -> list[Column]:
    """The tokens themselves and those that follow, as far as a mask reaches."""
    widest = max(map(len, masks))
    return [F.slice(column, i + 1, F.greatest(F.size(column), F.lit(1))) for i in range(widest)]


def _spans(df: DataFrame, masks: tuple[str, ...], *carried: str) -> DataFrame:
    """A row for each token: carried columns, its place, the span from it, prefix hash."""
    numbered = [x.alias(f"t{i}") for i, x in enumerate(_shifted("tokens", masks))]
    spans = df.select(*carried, F.posexplode(F.arrays_zip(*numbered)).alias("place", "span"))
    prefix = F.xxhash64(*[F.col(f"span.t{i}") for i in range(PREFIX)])
    return spans.withColumn("prefix", prefix)


def _seeds(spans: DataFrame, masks: tuple[str, ...], *carried: str) -> DataFrame:
    """A row for each span and mask that ends inside the text."""
    hashes = []
    for number, mask in enumerate(masks):
        picked = [F.col(f"span.t{i}") for i, bit in enumerate(mask) if bit == "1"]
        hashes.append(F.when(picked[-1].isNotNull(), F.xxhash64(F.lit(number), *picked)))
    rows = spans.select(*carried, "place", "prefix", F.explode(F.array(*hashes)).alias("seed"))
    return rows.where("seed IS NOT NULL")


def _total(flags: Column) -> Column:
    return F.aggregate(flags, F.lit(0), lambda total, x: total + x)


def _hits(
    texts: DataFrame, seeds: DataFrame, masks: tuple[str, ...]
) -> DataFrame:
    """(id, item, offset, n_tokens) wherever a seed of the texts is one of ``seeds``."""
    prefixes = F.broadcast(seeds.select("prefix").distinct())
    near = _spans(texts, masks, "id").join(prefixes, "prefix", "left_semi")
    known = F.broadcast(seeds.select("seed", "item", "item_place", "n_tokens"))
    hits = _seeds(near, masks, "id").join(known, "seed")
    offset = (F.col("place") - F.col("item_place")).alias("offset")
    return hits.select("id", "item", offset, "n_tokens").distinct()


def find_overlaps(
    documents: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    least_equal: int = LEAST_EQUAL,
) -> DataFrame:
    """(id, item, n_equal, n_tokens, place): confirmed overlaps, the best of each pair.

    ``n_equal`` counts the equal tokens at the best offset, ``n_tokens`` the item's, and
    ``place`` is the document's token at which the item would begin.
    """
    if any(not mask.startswith("1" * PREFIX) or mask[-1] != "1" for mask in masks):
        raise ValueError(f"a mask begins with {PREFIX} ones and ends with one")
    known = items.select(
        F.col(item_column).alias("item"), tokens(F.col(item_text_column)).alias("tokens")
    )
    known = known.where(F.size("tokens") >= min(map(len, masks))).dropDuplicates()
    known = known.withColumn("n_tokens", F.size("tokens"))
    seeds = staged(
        _seeds(_spans(known, masks, "item", "n_tokens"), masks, "item", "n_tokens")
        .withColumnRenamed("place", "item_place")
    )
    texts = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = texts.where("id IS NOT NULL")
    searched = texts.select("id", tokens(F.col("text")).alias("tokens"))
    n_blocks = max(1, -(-seeds.count() // BLOCK_SEEDS))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    found = [_hits(searched, seeds.where(block == i), masks) for i in range(n_blocks)]
    hits = staged(reduce(DataFrame.union, found))
    side = F.broadcast(hits) if hits.count() <= MOST_BROADCAST else hits

    # the part of each document that lies under the item
    skipped = F.greatest(-F.col("offset"), F.lit(0))
    start = F.greatest(F.col("offset"), F.lit(0))
    length = F.greatest(F.least(F.col("n_tokens") - skipped, F.size("tokens") - start), F.lit(0))
    laid = (
        texts.join(side, "id")
        .select("id", "item", "offset", "n_tokens", tokens(F.col("text")).alias("tokens"))
        .select(
            "id", "item", "offset", "n_tokens", skipped.alias("skipped"),
            F.slice("tokens", start + 1, length).alias("under"),
        )
    )
    over = F.slice("item_tokens", F.col("skipped") + 1, F.size("under"))
    flags = F.zip_with(over, "under", lambda a, b: F.when(a == b, 1).otherwise(0))
    own = known.withColumnRenamed("tokens", "item_tokens")
    compared = laid.join(own, ["item", "n_tokens"]).select(
        "id", "item", "n_tokens", "offset", flags.alias("flags")
    )
    width = F.least(F.col("n_tokens"), F.lit(window))
    needed = F.ceil(width * (least_equal / window))
    enough = compared.where(_total(F.col("flags")) >= needed)
    starts = F.sequence(F.lit(1), F.size("flags") - width + 1)
    is_close = F.exists(starts, lambda i: _total(F.slice("flags", i, width)) >= needed)
    # an item that sticks out of the document leaves fewer flags than the window is wide
    dense = F.when(F.size("flags") >= width, is_close).otherwise(True)
    best = F.max(F.struct(_total(F.col("flags")).alias("n_equal"), (-F.col("offset")).alias("back"), "n_tokens"))
    overlaps = enough.where(dense).groupBy("id", "item").agg(best.alias("best"))
    return overlaps.select(
        "id", "item", "best.n_equal", "best.n_tokens", (-F.col("best.back")).alias("place")
    )
