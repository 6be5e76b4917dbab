"""Every stage of the pipeline against what it has to do, on the test tables."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from test_dedup import brute_components
from test_text_rules import brute_overlaps

import corpus_pipeline
from tablecheck.llm import bpe


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after every stage at the smallest size."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(number))
        stage(spark, found[-1], sf_dir).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def texts(df):
    return {x.doc_id: x.text for x in df.collect()}


def test_columns_stay(stages):
    for after in stages[1:-1]:
        assert after.columns == stages[0].columns
        assert after.dtypes == stages[0].dtypes


def test_classifier_only_drops(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after.items() <= before.items() and len(after) > 0.5 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    components = brute_components(list(before.items()))
    assert after == {doc: before[doc] for doc, (_, least) in components.items() if doc == least}


def test_repeats_go(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert before.keys() == after.keys()
    strings, cut = {}, 0
    for text in before.values():
        data = text.encode()
        for p in range(len(data) - 199):
            strings[data[p : p + 200]] = strings.get(data[p : p + 200], 0) + 1
    for doc, text in before.items():
        data = text.encode()
        covered = bytearray(len(data))
        for p in range(len(data) - 199):
            if strings[data[p : p + 200]] > 1:
                covered[p : p + 200] = b"\1" * 200
        # a character stays if any of its bytes is not covered
        chars, at = [], 0
        for char in text:
            size = len(char.encode())
            if not all(covered[at : at + size]):
                chars.append(char)
            at += size
        assert after[doc] == "".join(chars)
        cut += after[doc] != text
    assert cut
    assert all(x.n_chars == len(x.text) for x in stages[3].collect())


def test_contaminated_documents_go(spark, stages):
    before, after = texts(stages[3]), texts(stages[4])
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    found = {doc for doc, _ in brute_overlaps(list(before.items()), [(x.item_id, x.text) for x in items])}
    assert after == {doc: text for doc, text in before.items() if doc not in found}


def test_tokens(stages):
    raw = open(public_tokenizers.path(corpus_pipeline.RANK_FILE), "rb").read()
    ranks = bpe.parse_ranks(raw)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = texts(stages[4])
    rows = stages[5].collect()
    assert {x.doc_id for x in rows} == before.keys()
    for x in rows:
        assert x.ids == library.encode_ordinary(before[x.doc_id])
        assert x.decoded_sha256 == hashlib.sha256(before[x.doc_id].encode()).hexdigest()


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id", "ids_sha256")
    assert sorted(rows.collect()) == sorted(stages[5].select("doc_id", "ids_sha256").collect())


def test_odd_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        rows = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, "/root/testdata/sf0.001")
            assert after.columns == docs.columns and after.count() <= rows
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == rows
