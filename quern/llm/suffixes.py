"""Suffix arrays by induced sorting and permuted common prefixes, for many shards at once.

Induced sorting walks a shard from place to place, each step depending on the one before.
A task has thousands of small shards, so one numpy step takes the same place of all of them.
Letters of different shards are different numbers, ascending from shard to shard; each shard
ends in a letter of its own that is its least.
"""

from __future__ import annotations

import numpy as np


def _walks(base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shards by falling size, and how many of them have a place ``i`` for each ``i``."""
    longest = np.argsort(-size, kind="stable")
    alive = len(size) - np.cumsum(np.bincount(size))[: int(size.max())]
    return base[longest], alive


def _induce(
    s: np.ndarray, kinds: np.ndarray, seeds: np.ndarray, base: np.ndarray, size: np.ndarray
) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones, ordered where letters are equal."""
    n = len(s)
    ends = np.cumsum(np.bincount(s))
    heads = np.concatenate(([0], ends[:-1]))
    # The letter before each position if a larger (smaller) suffix starts there, else -1; an
    # empty place is -1 and reads the last entry.
    larger, smaller = np.full(n + 1, -1), np.full(n + 1, -1)
    larger[1:n] = np.where(kinds[:-1], -1, s[:-1])
    smaller[1:n] = np.where(kinds[:-1], s[:-1], -1)
    larger[base] = smaller[base] = -1
    places = np.full(n, -1)
    by_letter = seeds[np.argsort(s[seeds], kind="stable")]
    letters = s[by_letter]
    total = np.cumsum(np.bincount(letters, minlength=len(ends)))
    places[ends[letters] - total[letters] + np.arange(len(letters))] = by_letter
    first, alive = _walks(base, size)
    for i in range(len(alive)):
        p = places[first[: alive[i]] + i]
        c = larger[p]
        go = np.flatnonzero(c >= 0)
        if len(go):
            c = c[go]
            at = heads[c]
            places[at] = p[go] - 1
            heads[c] = at + 1
    for i in range(len(alive) - 1, -1, -1):
        p = places[first[: alive[i]] + i]
        c = smaller[p]
        go = np.flatnonzero(c >= 0)
        if len(go):
            c = c[go]
            at = ends[c] - 1
            places[at] = p[go] - 1
            ends[c] = at
    return places


def _same_pieces(s: np.ndarray, p: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each piece of ``s`` (from ``p``, of ``length``) equals the one before it."""
    same = np.zeros(len(p), bool)
    same[1:] = length[1:] == length[:-1]
    left, off = np.flatnonzero(same), 0
    while len(left):
        equal = s[p[left] + off] == s[p[left - 1] + off]
        same[left[~equal]] = False
        off += 1
        left = left[equal & (length[left] > off)]
    return same


def sort_shards(s: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For shards at ``base`` of ``size`` in ``s``: the starts of their suffixes in order."""
    n, last = len(s), base + size - 1
    differs = np.where(s[:-1] != s[1:], np.arange(n - 1), n)
    change = np.minimum.accumulate(differs[::-1])[::-1]
    kinds = np.ones(n, bool)
    within = change < n
    kinds[:-1][within] = (s[:-1] < s[1:])[change[within]]
    kinds[last] = True
    mark = np.zeros(n, bool)
    mark[1:] = kinds[1:] & ~kinds[:-1]
    mark[last] = True
    leftmost = np.flatnonzero(mark)
    rough = _induce(s, kinds, leftmost, base, size)
    ordered = rough[mark[rough]]
    shard = np.searchsorted(last, leftmost)
    length = np.zeros(n, np.int64)
    length[leftmost[:-1]] = np.diff(leftmost) + 1
    length[last] = 1
    same = _same_pieces(s, ordered, length[ordered])
    if same.any():
        names = np.zeros(n, np.int64)
        names[ordered] = np.cumsum(~same)
        tied = np.zeros(len(base), bool)
        tied[np.searchsorted(last, ordered[same])] = True
        again = leftmost[tied[shard]]
        sizes = np.bincount(shard, minlength=len(base))[tied]
        order = again[sort_shards(names[again], np.cumsum(sizes) - sizes, sizes)]
        ordered = np.concatenate((ordered[~tied[np.searchsorted(last, ordered)]], order))
    return _induce(s, kinds, ordered, base, size)


def suffix_arrays(data: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """As ``sort_shards``, of bytes; the last byte of each shard is taken as its end."""
    s = data.astype(np.int64) + 1
    s[base + size - 1] = 0
    return sort_shards(s + np.repeat(np.arange(len(base)) * 257, size), base, size)


def common_prefixes(
    data: np.ndarray, order: np.ndarray, base: np.ndarray, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """For every position: the suffix before it in its shard (-1: none), and the bytes the two
    have in common, counted up to ``limit``, eight at a time."""
    n = len(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    before[order[base]] = -1
    padded = np.concatenate((data, np.zeros(limit + 8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded, (n + limit, 8), (1, 1))
    lengths = np.zeros(n, np.int64)
    p = np.flatnonzero(before >= 0)
    off = 0
    while len(p) and off < limit:
        equal = eight[p + off] == eight[before[p] + off]
        full = equal.all(axis=1)
        lengths[p] += np.where(full, 8, np.argmin(equal, axis=1))
        p, off = p[full], off + 8
    return before, np.minimum(lengths, limit)
