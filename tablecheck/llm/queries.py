"""The operators of this folder on the test tables, one query each."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import (
    bpe,
    collocations,
    conversation_repair,
    decontaminate,
    html_text,
    licenses,
    near_dedup,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    warc,
)
from tablecheck.llm.common import staged, table
from tablecheck.session import scratch_path

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable bundles and read back from them."""
    folder = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    index = staged(warc.write_bundles(warc.plan_records(pages, "page_id", "url", "html"), folder))
    bundles = index.select("bundle").distinct()
    # names are tiny: without a number of partitions one task would read every bundle
    tasks = min(bundles.count(), 4 * spark.sparkContext.defaultParallelism)
    records = warc.read_bundles(bundles.repartition(max(1, tasks)), folder, payloads=False)
    return records.select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and which."""
    found = decontaminate.find_overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 20-word passages that stand earlier."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, as digests."""
    raw_ranks = Path(public_tokenizers.path(RANK_FILE)).read_bytes()
    documents = table(spark, sf_dir, "documents")
    encoded = bpe.encode_digests(documents, "doc_id", "text", raw_ranks, public_tokenizers.PATTERN)
    return encoded.withColumnRenamed("id", "doc_id")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = html_text.extract_text(table(spark, sf_dir, "pages"), "html", ["page_id", "url"])
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model that never saw the held-out labels."""
    documents = table(spark, sf_dir, "documents")
    model = quality_classifier.train(documents, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(documents.select("doc_id", "text"), "text", model)
    return scored.select(
        "doc_id",
        quality_classifier.held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document; the smallest of each is kept."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that stand elsewhere too."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every whole text and of its lines."""
    known = licenses.known_licenses(spark)
    found = licenses.find_licenses(table(spark, sf_dir, "documents"), "doc_id", "text", known)
    return found.select(
        F.col("id").alias("doc_id"),
        "text_digest",
        "license",
        F.array_join("line_licenses", ",").alias("line_licenses"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures of every document, and whether it stays."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), "doc_id", "text")
    return judged.drop("distance").withColumnRenamed("id", "doc_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with faults put in, and its cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    damaged = conversation_repair.damaged(conversations)
    return conversation_repair.repair_all(conversations, damaged)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of every language."""
    return collocations.mine(table(spark, sf_dir, "documents"), "lang", "text")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of near duplicates of every document."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {
    "op1_warc_bundles": op1_warc_bundles,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_html_text": op5_html_text,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_collocations": op12_collocations,
    "op13_simhash_dedup": op13_simhash_dedup,
}
