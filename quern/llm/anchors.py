"""Windows dealt out to anchors, so that equal windows meet without shuffling every window.

A window is ``length`` consecutive positions (bytes or words) of one text. Its anchor is the
run of ``gram`` positions inside it with the least hash, the leftmost of equals. That depends
on the window alone: equal windows have equal anchors wherever they occur, and every window
has exactly one. Neighbouring windows mostly share theirs; each such run of windows is a
segment. Windows that occur twice are found by comparing segments of equal anchors only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from quern.llm.hashing import BLOCK, mixed, of_grams, of_ranges, prefix_sums

_PLACE = np.uint64((1 << 22) - 1)
PIECE = BLOCK  # a piece has fewer positions than _PLACE can count


@dataclass
class Segments:
    """Segment ``i`` holds the ``count[i]`` windows from position ``start[i]`` on; its anchor
    begins ``place[i]`` positions later, within or behind the first of them all."""

    start: np.ndarray
    place: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of every ``width`` consecutive values, the leftmost of equals."""
    n = len(h)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    least = np.minimum(ahead[: n - width + 1], behind[width - 1 : n])
    return (least & _PLACE).astype(np.int64)


def _piece(values: np.ndarray, last: np.ndarray, length: int, gram: int) -> Segments:
    grams = of_grams(values, gram)
    anchor = least_in_windows(grams, length - gram + 1)
    whole = np.arange(length, length + len(anchor)) <= last[: len(anchor)]
    begins = whole.copy()
    begins[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1])
    ends = whole.copy()
    ends[:-1] &= ~whole[1:] | (anchor[1:] != anchor[:-1])
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends)
    content = of_ranges(prefix_sums(values), start, stop + length)
    count = stop - start + 1
    return Segments(start, anchor[start] - start, count, grams[anchor[start]], mixed(content + count.astype(np.uint64)))


def segments(
    values: np.ndarray, start: np.ndarray, end: np.ndarray, length: int, gram: int
) -> Segments:
    """Segments of the texts that lie at ``start`` to ``end`` of ``values``."""
    last = np.repeat(end, end - start)
    parts = []
    for at in range(0, max(0, len(values) - length + 1), PIECE):
        to = min(len(values), at + PIECE + length - 1)
        part = _piece(values[at:to], last[at:to] - at, length, gram)
        part.start += at
        parts.append(part)
    if not parts:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Segments(
        *(np.concatenate([getattr(p, f) for p in parts]) for f in ("start", "place", "count", "anchor", "content"))
    )
