"""From raw documents to tokens: five stages, each over all that the one before kept.

``run`` writes the result of every stage but the last as Parquet in the folder all
executors share, and the next stage reads it from there, so a lost executor repeats part
of one stage only.

Rules for odd input: rows that repeat an identifier stay or go together, except that the
classifier judges each text on its own; rows with a NULL identifier are judged by the
classifier, compared with nothing and kept; NULL texts are empty; extra columns are
carried through to the last stage; empty tables pass through.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import bpe, decontaminate, near_dedup, quality_classifier, suffix_dedup
from tablecheck.llm.common import staged, table
from tablecheck.session import scratch_path

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: More identifiers than this are matched by a shuffle (8 bytes each).
MOST_BROADCAST = 2_000_000


def _free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if a column has it already."""
    taken = {x.lower() for x in df.columns}
    while name in taken:
        name += "_"
    return name


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose identifier is not in the one column of ``ids``."""
    name = _free_name(docs, "gone")
    gone = staged(ids.toDF(name).distinct())
    side = F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone
    return docs.join(side, docs["doc_id"] == side[name], "left_anti")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    name = _free_name(docs, "score")
    return quality_classifier.score(docs, "text", model, name).where(F.col(name) >= 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest identifier of each group of near duplicates."""
    found = near_dedup.near_duplicates(docs, "doc_id", "text")
    return _without(docs, found.where("doc_id <> component_id").select("doc_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands elsewhere too, cut at whole characters."""
    found = suffix_dedup.remove_repeats(docs, "doc_id", "text", characters=True)
    names = [_free_name(docs, x) for x in ("cut_id", "cut_key", "cut_text")]
    cut = found.where("n_removed > 0").select(
        F.col("doc").alias(names[0]),
        F.col("text_key").alias(names[1]),
        F.col("kept").cast("string").alias(names[2]),
    )
    path = scratch_path(spark, "cut")
    cut.dropDuplicates(names[:2]).write.parquet(path)
    cut = spark.read.parquet(path)
    key = F.xxhash64(F.coalesce(docs["text"].cast("binary"), F.lit(b"")))
    same = (docs["doc_id"] == cut[names[0]]) & (key == cut[names[1]])
    keys = cut.select(*names[:2])
    small = keys.count() <= MOST_BROADCAST
    side = F.broadcast(keys) if small else keys
    same_key = (docs["doc_id"] == side[names[0]]) & (key == side[names[1]])
    touched = docs.join(side, same_key, "left_semi")
    changed = {"text": F.col(names[2])}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(names[2]).cast(docs.schema["n_chars"].dataType)
    joined = touched.join(cut, same).withColumns(changed).select(*docs.columns)
    return joined.unionByName(docs.join(side, same_key, "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select("id"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    raw_ranks = Path(public_tokenizers.path(RANK_FILE)).read_bytes()
    pattern = public_tokenizers.PATTERN
    encoded = bpe.encode_digests(docs, "doc_id", "text", raw_ranks, pattern, with_ids=True)
    return encoded.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", classify),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: SQL cannot train a classifier or follow components; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
