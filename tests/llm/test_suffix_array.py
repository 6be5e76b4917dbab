from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablecheck.llm import suffix_dedup
from tablecheck.llm.suffix_array import common_prefixes, suffix_array


def check(data: bytes, most: int) -> None:
    array = np.frombuffer(data, np.uint8)
    order = suffix_array(array)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    found = common_prefixes(array, order, most)
    for rank in range(1, len(data)):
        a, b = data[order[rank - 1] :], data[order[rank] :]
        same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert found[rank] == min(same, most)


@pytest.mark.parametrize("size", [0, 1, 2, 7, 8, 9, 511, 512, 513, 1500])
@pytest.mark.parametrize("letters", [1, 2, 4])
def test_random_bytes(size, letters):
    check(np.random.default_rng(size).integers(0, letters, size).astype(np.uint8).tobytes(), 200)


@given(st.binary(max_size=60), st.integers(1, 5), st.integers(1, 30))
@settings(max_examples=150, deadline=None)
def test_repeats(data, times, most):
    check(data * times, most)


def test_a_shard_holds_few_bytes_for_each_of_its_own():
    """Two tasks of an executor sort shards at once: the arrays of one stay small."""
    pick = np.random.default_rng(4)
    line = pick.integers(0, 256, 230, np.uint8).tobytes()
    parts = [line + pick.integers(0, 256, 90, np.uint8).tobytes() for _ in range(1_500)]
    blocks = pd.DataFrame({"hash": 0, "piece": 0, "pieces": 1, "alone": True, "doc": range(1_500)})
    blocks = blocks.assign(start=0, data=parts)
    tracemalloc.start()
    found = suffix_dedup._shard(blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 1_500 and found["end"].min() == 230
    assert peak < 50 * sum(map(len, parts))
