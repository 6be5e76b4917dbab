from __future__ import annotations

import hashlib
import random
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

from tablecheck.llm import bpe

RAW = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RAW, PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.parse_ranks(RAW)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(seed, alphabet, count, longest):
    pick = random.Random(seed)
    for _ in range(count):
        yield "".join(pick.choice(alphabet) for _ in range(pick.randint(0, longest)))


@pytest.mark.parametrize("alphabet", ["abcdeinorst ", "ñéü漢🎉 0123!#\n\t", "a", "\x00\x7f é"])
def test_random_texts_encode_like_the_library(codec, reference, alphabet):
    texts = list(random_texts(7, alphabet, 400, 80))
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_every_token_is_its_own_encoding(codec):
    for token, rank in list(codec.vocabulary.usable.items())[::37]:
        assert bpe.PrefixEncoding(codec.vocabulary, token).ids() == [rank]


def test_appends_give_the_encoding_of_every_prefix(codec):
    word = "Donaudampfschifffahrtsgesellschaft".encode()
    grown = bpe.PrefixEncoding(codec.vocabulary)
    for i in range(len(word)):
        grown.append(word[i : i + 1])
        assert grown.ids() == bpe.PrefixEncoding(codec.vocabulary, word[: i + 1]).ids()
        assert bpe.PrefixEncoding(codec.vocabulary, word).ids(i + 1) == grown.ids()


def test_edits_make_few_entries_and_the_same_ids(codec):
    pick = random.Random(3)
    data = "".join(random_texts(5, "abcdeinorst", 60, 40)).encode()
    for _ in range(40):
        start = pick.randrange(len(data) - 10)
        stop, new = start + pick.randrange(8), bytes(pick.choices(b"abcinorst", k=pick.randrange(6)))
        edited = bpe.PrefixEncoding(codec.vocabulary, data)
        made = edited.replace(start, stop, new)
        whole = bpe.PrefixEncoding(codec.vocabulary, data[:start] + new + data[stop:])
        assert edited.ids() == whole.ids()
        assert made <= len(whole.data) - start
    first = bpe.PrefixEncoding(codec.vocabulary, data)
    assert first.replace(10, 12, b"zz") < len(data) // 2


def test_full_cache_changes_nothing(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 5)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 100)
    texts = list(random_texts(11, "abcde fgh", 50, 60))
    small = bpe.Codec(RAW, PATTERN)
    for text, ids in zip(texts, small.encode_all(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)


def test_tables(spark, odd_documents, no_documents, reference):
    rows = bpe.encode_digests(odd_documents, "doc_id", "text", RAW, PATTERN, with_ids=True).collect()
    texts = sorted(x.text or "" for x in odd_documents.collect())
    assert sorted(bytes(reference.decode_bytes(x.ids)).decode() for x in rows) == texts
    for row in rows:
        assert row.n_tokens == len(row.ids)
        text = ",".join(map(str, row.ids)).encode()
        assert row.ids_sha256 == hashlib.sha256(text).hexdigest()
    ids = bpe.encode_texts(odd_documents, "doc_id", "text", RAW, PATTERN)
    data = bpe.decode_ids(ids, "id", "ids", RAW, PATTERN).collect()
    assert sorted(bytes(x.data).decode() for x in data) == texts
    assert bpe.encode_digests(no_documents, "doc_id", "text", RAW, PATTERN).count() == 0
