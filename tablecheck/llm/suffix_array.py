"""Suffix arrays of byte strings in numpy, for one task's share of the data.

Larsson-Sadakane refinement: suffixes are sorted by their first eight bytes, then groups
that still tie are refined by the rank of the suffix twice as far on, and singletons are
never touched again. Kasai's common prefixes run over many stretches of the text at once.
Places and ranks are 32-bit numbers, half of what a task would hold otherwise: a share of the
data has less than 2^31 bytes.
"""

from __future__ import annotations

import numpy as np

#: Text positions that one lane of the common prefixes walks through.
STRETCH = 512


def eight_bytes(data: np.ndarray, margin: int = 8) -> np.ndarray:
    """At each place the next eight bytes as a big-endian number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(margin + 8, np.uint8)])
    count = len(data) + margin
    value = np.zeros(count, np.uint64)
    for k in range(8):
        value = (value << np.uint64(8)) | padded[k : k + count]
    return value


def _firsts(new: np.ndarray) -> np.ndarray:
    """The place of the first member of the group that each place is in."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new), dtype=np.int32), np.int32(0)))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in their order; a suffix that ends first goes first."""
    size = len(data)
    if size == 0:
        return np.empty(0, np.int32)
    keys = eight_bytes(data)[:size]
    order = np.argsort(keys, kind="stable").astype(np.int32)
    keys = keys[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    del keys
    # the rank of a group is the place of its first member, from 1; what ends before the
    # place to compare is below 1, the lower the sooner
    rank = np.empty(size, np.int32)
    rank[order] = _firsts(new) + 1
    tied = np.flatnonzero(~(new & np.r_[new[1:], True])).astype(np.int32)
    step = 8
    while len(tied):
        suffixes = order[tied]
        beyond = suffixes + step
        follow = np.where(beyond < size, rank[np.minimum(beyond, size - 1)], size - beyond)
        keys = rank[suffixes].astype(np.int64)
        keys *= size + step + 1
        keys += follow + step
        del beyond, follow
        sorted_ = np.argsort(keys, kind="stable").astype(np.int32)
        suffixes, keys = suffixes[sorted_], keys[sorted_]
        order[tied] = suffixes
        new = np.r_[True, keys[1:] != keys[:-1]]
        del keys, sorted_
        rank[suffixes] = tied[_firsts(new)] + 1
        tied = tied[~(new & np.r_[new[1:], True])]
        step *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it, up to ``most``.

    By Kasai's rule a position's prefix is at most one shorter than that of the position
    before it in the text, so a lane only ever looks at bytes it has not matched yet.
    """
    size = len(data)
    if size == 0:
        return np.empty(0, np.int32)
    words = eight_bytes(data, most + 16)
    before = np.full(size, -1, np.int32)
    before[order[1:]] = order[:-1]
    found = np.zeros(size, np.int32)
    starts = np.arange(0, size, STRETCH)
    length = np.zeros(len(starts), np.int64)
    for offset in range(min(STRETCH, size)):
        lanes = len(starts) if starts[-1] + offset < size else len(starts) - 1
        at = starts[:lanes] + offset
        other = before[at]
        own = np.where(other < 0, 0, np.maximum(length[:lanes] - 1, 0))
        other = np.maximum(other, 0)
        open_ = np.flatnonzero((before[at] >= 0) & (own < most))
        while len(open_):
            so_far = own[open_]
            a, b = words[at[open_] + so_far], words[other[open_] + so_far]
            equal = a == b
            apart = open_[~equal]
            if len(apart):
                differ = (a ^ b)[~equal]
                matched = sum((differ < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8))
                own[apart] += matched
            open_ = open_[equal]
            own[open_] += 8
            open_ = open_[own[open_] < most]
        own = np.minimum(np.minimum(own, most), size - np.maximum(at, other))
        length[:lanes] = own
        found[at] = np.where(before[at] >= 0, own, 0)
    return found[order]
