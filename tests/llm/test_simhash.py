"""SimHash fingerprints and their components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from tablecheck.llm import simhash_dedup


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split("[ \t\n\v\f\r]+", lowered) if w]
    size = min(3, len(words))
    parts = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """doc -> smallest document in reach, for (doc, print) rows."""
    label = {doc: doc for doc, _ in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, one) in enumerate(prints):
        for b, other in prints[:i]:
            if (one ^ other).bit_count() <= 2:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {doc: root(doc) for doc in label}


def check(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash_dedup.near_duplicates(frame, "doc_id", "text").collect()
    prints = [(doc, plain_fingerprint(text)) for doc, text in rows]
    labels = plain_components(prints)
    expected = sorted((doc, f"{p:016x}", labels[doc]) for doc, p in prints)
    assert sorted(map(tuple, found)) == expected


def test_fingerprint_of_any_text(sentence):
    texts = [None, "", " \n", "One", "One two", "A b c", "É x \x1c y Z", sentence * 3, "w " * 70_000]
    texts.append(" ".join(str(i) for i in range(150_000)))
    for text in texts:
        data = None if text is None else text.encode()
        assert simhash_dedup.fingerprint(data) == plain_fingerprint(text)


def test_documents_with_near_and_exact_copies(spark):
    draw = random.Random(4)
    rows, words = [], [f"w{i}" for i in range(500)]
    for k in range(60):
        text = draw.choices(words, k=draw.randrange(1, 300))
        for copy in range(draw.randrange(1, 5)):
            changed = list(text)
            for _ in range(draw.randrange(2)):
                changed[draw.randrange(len(changed))] = draw.choice(words)
            rows.append((10 * k + copy, " ".join(changed)))
    check(spark, rows)


def test_odd_tables(spark, odd_documents, no_documents):
    found = simhash_dedup.near_duplicates(odd_documents, "doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in odd_documents.collect() if r.doc_id is not None]
    prints = [(doc, plain_fingerprint(text)) for doc, text in rows]
    labels = plain_components(prints)
    assert sorted(map(tuple, found)) == sorted((d, f"{p:016x}", labels[d]) for d, p in prints)
    assert simhash_dedup.near_duplicates(no_documents, "doc_id", "text").count() == 0


def test_one_identifier_with_two_texts_ties_their_groups(spark):
    rows = [(5, "a b c d"), (5, "x y z"), (7, "x y z"), (9, "a b c d"), (2, "other words here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash_dedup.near_duplicates(frame, "doc_id", "text").collect()
    assert {r.doc_id: r.component_id for r in found} == {5: 5, 7: 5, 9: 5, 2: 2}
    assert len(found) == 5


def signed(prints):
    return [int(np.uint64(p).view(np.int64)) for p in prints]


@pytest.mark.parametrize("small_group", [4, 1024])
def test_all_links_hold_in_dense_groups(spark, monkeypatch, small_group):
    """Fingerprints around few centres: chains, and groups that are dealt again."""
    monkeypatch.setattr(simhash_dedup, "SMALL_GROUP", small_group)
    draw = random.Random(small_group)
    prints = {0, 3, 7, 15, 2**64 - 1, 2**63, 2**63 + 1}
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            flipped = sum(1 << b for b in draw.sample(range(64), draw.randrange(5)))
            prints.add(centre ^ flipped)
    rows = list(zip(range(len(prints)), sorted(prints)))
    frame = spark.createDataFrame(
        [(i, s) for i, s in zip(range(len(rows)), signed([p for _, p in rows]))], "rep long, print long"
    )
    from tablecheck.llm.components import components

    found = components(simhash_dedup.links(frame)).collect()
    mine = {i: i for i, _ in rows} | {r.node: r.component for r in found}
    assert mine == plain_components(rows)


def test_tables_discard_most_pairs_and_no_near_one():
    draw = np.random.default_rng(8)
    prints = draw.integers(0, 2**64, 400, dtype=np.uint64)
    near = prints[:50] ^ (np.uint64(1) << draw.integers(0, 64, 50, dtype=np.uint64))
    both = np.r_[prints, near]
    found, looked, survived = simhash_dedup.group_links(
        np.arange(len(both)), both, simhash_dedup.distance_table(both)
    )
    assert {(i, 400 + i) for i in range(50)} <= set(found)
    assert looked == len(both) * (len(both) - 1) // 2 and survived < looked / 100


def test_blocks_leave_no_near_pair_out():
    for bits in [(a, b) for a in range(64) for b in range(a, 64)]:
        apart = 1 << bits[0] | 1 << bits[1]
        assert any(not mask & apart for mask in simhash_dedup.FIRST)
        for first, finer in zip(simhash_dedup.FIRST, simhash_dedup.SECOND):
            assert first & apart or any(not mask & apart for mask in finer)
    assert min(m.bit_count() for finer in simhash_dedup.SECOND for m in finer) == 53
