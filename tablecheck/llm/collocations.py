"""Collocations of two and three words by best-first branch-and-bound growth.

Words and pairs are counted first; only words that come ``LEAST_COUNT`` times can be part of a
phrase that does. Growing a pair to a phrase of three words is what costs, so a pair is
expanded in the order of an admissible bound: a phrase that begins with ``xy`` comes at most
f(xy) times, so its first cut scores at most f(xy) / f(x); read from its end the same holds
for f(yz) / f(z). The frontier of a language is the pairs whose bounds reach a threshold,
which starts at the score of the pair of rank ``AHEAD`` * ``most``. All phrases that reach it
are counted then, together with those that could drop a pair that reaches it. If at least
``most`` phrases survive, the last of them, ties included, lies at or above the threshold, and
no unexpanded pair can lead to another: the language is settled. Else its threshold falls and
the frontier grows; at zero everything is expanded.

Tasks are told the frontier as bit maps of fixed size (``SLOTS`` bits), which may let more
pairs through but never fewer; what they count is joined with the exact tables. Counts travel
as 64-bit hashes of words and are added up in the tasks first, so a word, pair or line that
fills a third of the text is one row of a task. Scores are exact decimals.

Rules for odd input: NULL text is empty; NULL language is ``und``; a text without words gives
nothing; equal scores stand by count, then by phrase; texts may be of any length; repeated
rows count each; extra columns are not looked at; an empty table gives an empty result.
Results are exact up to collisions of 64-bit hashes of words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.llm.common import staged
from tablecheck.llm.words import CACHED_WORDS, mixed

LEAST_COUNT = 10
MOST = 2000
#: A phrase is dropped inside one that comes in this share of its places.
DROP_PERCENT = 50
SCALE = 1_000_000
#: The first threshold is the score of the pair of this rank, in units of the wanted number.
AHEAD = 2
#: Bits of a bit map; a multiple of 32,768.
SLOTS = 2**24
#: Tasks that order a part of each language.
PARTS = 32
#: Bytes of text taken at a time.
CHUNK = 4_000_000
NO_LANGUAGE = "und"

#: What ends a piece, and the white space between words.
SEPARATORS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
_table = bytearray(range(256))
for _byte in SEPARATORS:
    _table[_byte] = 10
_table[9] = 32
PLAIN = bytes(_table)

#: Hashes that stand for no word and for the end of a piece.
NOTHING, BREAK = 0, 1
FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


class Tokens(dict):
    """Hash of a word (bytes), remembered; the end of a piece is the word of one line feed."""

    def __init__(self) -> None:
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self[b""], self[b"\n"] = NOTHING, BREAK

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = word_hash(word)
        return value


def word_hash(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word)
    return value if value > BREAK else value + 2


def tokens(text: bytes) -> list[bytes]:
    """Words, empty ones between several blanks, and a line feed at each end of a piece."""
    plain = text.lower().translate(PLAIN)
    return plain.replace(b"\n", b" \n ").split(b" ")


def _chunks(batch: pa.RecordBatch, most: int) -> Iterator[tuple[str, bytes]]:
    """Texts of one language, joined as pieces, up to about ``most`` bytes."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()
    for lang, text in zip(batch.column(0), batch.column(1)):
        name, value = lang.as_py(), text.as_py()
        held.setdefault(name, []).append(value)
        sizes[name] += len(value)
        if sizes[name] >= most:
            yield name, b"\n".join(held.pop(name))
            sizes[name] = 0
    for name, values in held.items():
        yield name, b"\n".join(values)


def _texts(df: DataFrame, lang_column: str, text_column: str) -> DataFrame:
    return df.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("text"),
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, w, n): every word, its hash and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in _chunks(batch, CHUNK):
                found = Counter(tokens(text))
                for no_word in (b"", b"\n"):
                    found.pop(no_word, None)
                columns = [
                    pa.array([lang] * len(found), pa.string()),
                    pa.array(list(found), pa.binary()),
                    pa.array(list(found.values()), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    counted = texts.mapInArrow(run, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hashed(words: DataFrame) -> DataFrame:
    """The words with their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [word_hash(w) for w in batch.column("word").to_pylist()]
            hashes = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, hashes], ["lang", "word", "n", "w"])

    return words.select("lang", "word", "n").mapInArrow(
        run, "lang string, word binary, n long, w long"
    )


def slots(size: int, lang: str, *parts: np.ndarray) -> np.ndarray:
    """Places of phrases (hashes of their words) in a bit map of that size."""
    total = np.full(len(parts[0]), xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
    for part in parts:
        total = mixed(total * FACTORS[0] + part)
    return total & np.uint64(size - 1)


def bit_map(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """Bits of the phrases (lang and the hashes of their words) in ``rows``.

    Joined by Spark to a map of ``SLOTS`` bits, whatever the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.zeros(batch.num_rows, np.int64)
            langs = np.array(batch.column(0).to_pylist(), object)
            hashes = [c.to_numpy().view(np.uint64) for c in batch.columns[1:]]
            for lang in set(langs.tolist()):
                of = np.flatnonzero(langs == lang)
                place[of] = slots(SLOTS, lang, *[h[of] for h in hashes]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place)], ["slot"])

    places = rows.select("lang", *columns).mapInArrow(run, "slot long")
    parts = places.groupBy((F.col("slot") / 32768).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("slot") % 32768)).alias("bits")
    )
    whole = np.zeros(SLOTS // 8, np.uint8)
    for bucket, bits in parts.collect():
        whole[bucket * 4096 : (bucket + 1) * 4096] = np.frombuffer(bits, np.uint8)
    return whole


def has(bits: np.ndarray, lang: str, *parts: np.ndarray) -> np.ndarray:
    """Which phrases (hashes of their words) may be in the map."""
    at = slots(8 * len(bits), lang, *parts)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _counted(parts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct phrases and their counts."""
    key = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        key = mixed(key * FACTORS[1] + part)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return [part[first] for part in parts], counts


def _phrases(texts: DataFrame, size: int, choose) -> DataFrame:
    """Counts of the phrases of ``size`` words that ``choose(lang, hashes)`` lets through."""
    names = [f"w{i + 1}" for i in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch in batches:
            for lang, text in _chunks(batch, CHUNK):
                found = tokens(text)
                hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
                del found
                hashes = hashes[hashes != NOTHING]
                if len(hashes) < size:
                    continue
                parts = [hashes[i : len(hashes) - size + 1 + i] for i in range(size)]
                inside = np.logical_and.reduce([part != BREAK for part in parts])
                parts = [part[inside] for part in parts]
                chosen = choose(lang, hashes, inside, parts)
                parts, counts = _counted([part[chosen] for part in parts])
                columns = [pa.array([lang] * len(counts), pa.string())]
                columns += [pa.array(part.view(np.int64)) for part in parts]
                columns.append(pa.array(counts.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["lang", *names, "a"])

    schema = ", ".join(["lang string", *[f"{n} long" for n in names], "a long"])
    counted = texts.mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("a").alias("a"))
    return counted.where(F.col("a") >= LEAST_COUNT)


def pair_counts(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, w1, w2, a, f1, f2): pairs that come often enough, and the counts of their words."""
    often = bit_map(words, ["w"])
    context = words.sparkSession.sparkContext
    shared = context.broadcast(often)

    def choose(lang, hashes, inside, parts):
        return np.logical_and.reduce([has(shared.value, lang, part) for part in parts])

    pairs = _phrases(texts, 2, choose)
    for k in (1, 2):
        side = words.select("lang", F.col("w").alias(f"w{k}"), F.col("n").alias(f"f{k}"))
        pairs = pairs.join(side.hint("merge"), ["lang", f"w{k}"])
    return pairs


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact; counts below 10^15."""
    d = {c: f"CAST({c} AS DECIMAL(15,0))" for c in (a, left, right)}
    return F.expr(f"CAST({SCALE} * {d[a]} * {d[a]} DIV ({d[left]} * {d[right]}) AS LONG)")


def _expanded(
    texts: DataFrame, pairs: DataFrame, words: DataFrame, threshold: DataFrame
) -> DataFrame:
    """Phrases of three words that reach the threshold of their language or could drop a pair
    that does: (lang, w1, w2, w3, a, l, r, score)."""
    # a / f(x) >= threshold / SCALE, without rounding
    near = pairs.join(F.broadcast(threshold), "lang")
    reach = near.select(
        "lang",
        "w1",
        "w2",
        (F.col("a") * SCALE >= F.col("threshold") * F.col("f1")).alias("begins"),
        (F.col("a") * SCALE >= F.col("threshold") * F.col("f2")).alias("ends"),
        (F.col("score") >= F.col("threshold")).alias("watched"),
    )
    reach = staged(reach)
    maps = [bit_map(reach.where(c), ["w1", "w2"]) for c in ("begins", "ends", "watched", "true")]
    shared = texts.sparkSession.sparkContext.broadcast(maps)

    def choose(lang, hashes, inside, parts):
        first, second = ([has(m, lang, *parts[i : i + 2]) for m in shared.value] for i in (0, 1))
        begins, watched, known = first[0], first[2], first[3]
        wanted = begins & second[1] | watched & second[3]
        return wanted | known & second[2]

    found = _phrases(texts.join(F.broadcast(threshold.select("lang")), "lang"), 3, choose)
    counts = pairs.select("lang", "w1", "w2", "a")
    for a, b, name in (("w1", "w2", "f12"), ("w2", "w3", "f23")):
        side = counts.toDF("lang", a, b, name)
        found = found.join(side.hint("merge"), ["lang", a, b])
    for k in (1, 3):
        side = words.select("lang", F.col("w").alias(f"w{k}"), F.col("n").alias(f"f{k}"))
        found = found.join(side.hint("merge"), ["lang", f"w{k}"])
    found = found.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    return staged(
        found.select(
            "lang",
            "w1",
            "w2",
            "w3",
            "a",
            F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
            F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
    )


def _surviving(pairs: DataFrame, triples: DataFrame, threshold: DataFrame) -> DataFrame:
    """Phrases that reach the threshold of their language and stand in no frequent longer one."""
    near = pairs.join(F.broadcast(threshold), "lang").where("score >= threshold")
    own = triples.join(F.broadcast(threshold), "lang").where("score >= threshold")
    inside = triples.selectExpr("lang", "w1", "w2", "a AS longer").unionByName(
        triples.selectExpr("lang", "w2 AS w1", "w3 AS w2", "a AS longer")
    )
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    kept = near.join(longest.hint("merge"), ["lang", "w1", "w2"], "left").where(
        f"longer IS NULL OR 100 * longer < {DROP_PERCENT} * a"
    )
    kept = kept.selectExpr("lang", "w1", "w2", "CAST(NULL AS LONG) w3", "a", "f1 l", "f2 r", "score")
    return kept.unionByName(own.drop("threshold"))


def _ranked(rows: DataFrame, most: int, *order: Column) -> DataFrame:
    """The first ``most`` rows of each language.

    In two steps: a language is dealt over ``PARTS`` tasks, each of which keeps its first
    rows, so that the task that orders a language sees a bounded number of rows.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS)).alias("part")
    dealt = rows.select("*", part)
    for keys in (("lang", "part"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        dealt = dealt.withColumn("rank", place).where(F.col("rank") <= most)
    return dealt.drop("part")


def _threshold(pairs: DataFrame, langs: DataFrame, rank: int) -> DataFrame:
    """(lang, threshold): the score of the pair of that rank, zero where there are fewer."""
    top = _ranked(pairs.select("lang", "score"), rank, F.desc("score"))
    last = top.where(F.col("rank") == rank).select("lang", F.col("score").alias("threshold"))
    met = langs.join(last, "lang", "left")
    return staged(met.select("lang", F.coalesce("threshold", F.lit(0)).cast("long").alias("threshold")))


def mine(df: DataFrame, lang_column: str, text_column: str, most: int = MOST) -> DataFrame:
    """The first ``most`` collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = _texts(df, lang_column, text_column)
    every = staged(word_counts(texts))
    totals = staged(every.groupBy("lang").agg(F.sum("n").alias("n")))
    words = staged(_hashed(every.where(F.col("n") >= LEAST_COUNT)))
    pairs = pair_counts(texts, words)
    pairs = staged(pairs.withColumn("score", _score("a", "f1", "f2")))
    open_, rank, settled = totals.select("lang"), AHEAD * most, []
    while True:
        threshold = _threshold(pairs, open_, rank)
        triples = _expanded(texts, pairs, words, threshold)
        found = staged(_surviving(pairs, triples, threshold))
        state = threshold.join(found.groupBy("lang").agg(F.count("*").alias("found")), "lang", "left")
        state = staged(state.withColumn("done", F.expr(f"threshold = 0 OR found >= {most}")))
        done = state.where("done").select("lang")
        settled.append(found.join(F.broadcast(done), "lang", "left_semi"))
        open_ = staged(state.where("NOT coalesce(done, false)").select("lang"))
        if open_.isEmpty():
            break
        rank *= 4
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    for k in (1, 2, 3):
        side = words.select("lang", F.col("w").alias(f"w{k}"), F.col("word").cast("string").alias(f"t{k}"))
        rows = rows.join(side.hint("merge"), ["lang", f"w{k}"], "left")
    named = rows.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    top = _ranked(named.select("lang", "phrase", "a", "l", "r", "score"), most, *order)
    return top.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
