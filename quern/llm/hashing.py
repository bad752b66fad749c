"""Hashes of many texts at once, in numpy, over the bytes of an Arrow batch.

A range of bytes or words is hashed by a polynomial modulo 2**64 over random values, so
that the hash of any range follows from prefix sums; the result is mixed before use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18  # arrays of a block fit the cache
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240229)
BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    if len(_tables.get("power", ())) < n:
        size = max(n, BLOCK + 4096)
        for name, base in (("power", _BASE), ("inverse", _INVERSE)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _tables[name] = np.cumprod(values)
    return _tables["power"], _tables["inverse"]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which every bit depends on every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values))[0][: len(values)], out=out[1:])
    return out


def of_ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges from ``start`` to before ``end``, wherever they stand."""
    return mixed((sums[end] - sums[start]) * _powers(len(sums))[1][start])


def of_grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` values."""
    sums, n = prefix_sums(values), len(values) - k + 1
    return mixed((sums[k:] - sums[:-k]) * _powers(len(sums))[1][:n])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


@dataclass
class Texts:
    """Whole texts laid end to end: ``data`` and where each begins and ends; ``first`` is the
    number of the first one in its batch."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: int


def texts(column: pa.Array, block: int = BLOCK) -> Iterator[Texts]:
    """The texts of a batch in blocks of about ``block`` bytes; null counts as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block, "right")) - 1)
        low = offsets[at]
        yield Texts(data[low : offsets[to]], offsets[at:to] - low, offsets[at + 1 : to + 1] - low, at)
        at = to


@dataclass
class Words:
    """The blank-separated words of some texts: hash, first and past-the-end byte of each word;
    text ``i`` has those from ``start[i]`` to before ``end[i]``."""

    hashes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words(t: Texts, table: np.ndarray = BYTE) -> Words:
    """Words of ``t``. A text longer than a block is hashed piece by piece between words."""
    inside = ~SPACE[t.data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = t.end > t.start
    heads, tails = t.start[filled], t.end[filled] - 1
    begins[heads] = inside[heads]
    ends[tails] = inside[tails]
    low, high = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(low), np.uint64)
    at = 0
    while at < len(low):
        to = max(at + 1, int(np.searchsorted(high, low[at] + BLOCK, "right")))
        base = low[at]
        sums = prefix_sums(table[t.data[base : high[to - 1]]])
        hashes[at:to] = of_ranges(sums, low[at:to] - base, high[at:to] - base)
        at = to
    return Words(hashes, low, high, np.searchsorted(low, t.start), np.searchsorted(low, t.end))
