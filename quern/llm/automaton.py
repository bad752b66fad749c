"""A generalised suffix automaton over the words of many items."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """Every run of words of any item is a path from state 0.

    A window is ``n`` consecutive words of an item, or the whole of a shorter item. For each
    state the items are known whose window ends there.
    """

    def __init__(self, items: Sequence[tuple[str, Sequence[bytes]]], n: int):
        self.n = n
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            code = [self.ids.setdefault(w, len(self.ids)) for w in words]
            coded.append((item, code))
            last = 0
            for c in code:
                last = self._extend(last, c)
        self.least = min([n, *(len(code) for _, code in coded if code)])
        self._mark(coded)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of the longest run through ``p`` and ``c``, parted from ``q`` if longer."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, self.next[last][c], c)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][c], c)
        return new

    def _mark(self, coded: Sequence[tuple[str, Sequence[int]]]) -> None:
        """``full``: state to the items with a window of n words there; ``short``: state to
        (length, item) of shorter items that end there or at a shorter suffix."""
        by_length = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.owner = list(range(len(self.length)))  # the state of the last n words
        for v in by_length[1:]:
            if self.length[self.link[v]] >= self.n:
                self.owner[v] = self.owner[self.link[v]]
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, code in coded:
            v = 0
            for i, c in enumerate(code):
                v = self.next[v][c]
                if i + 1 >= self.n:
                    self.full.setdefault(self.owner[v], set()).add(item)
            if 0 < len(code) < self.n:
                self.short.setdefault(v, []).append((len(code), item))
        for v in by_length[1:]:
            inherited = self.short.get(self.link[v])
            if inherited:
                self.short[v] = self.short.get(v, []) + inherited

    def matches(self, code: Sequence[int], start: int, found: set[str]) -> tuple[list[tuple[int, int]], int]:
        """Ranges of ``code`` (numbers of known words) hit by windows, counted from ``start``,
        and the longest match; adds the items to ``found``."""
        following, link, length = self.next, self.link, self.length
        v = have = longest = 0
        hits = []
        for i, c in enumerate(code):
            while v and c not in following[v]:
                v = link[v]
                have = length[v]
            if c in following[v]:
                v = following[v][c]
                have += 1
            longest = max(longest, have)
            reach = 0
            if have >= self.n:
                items = self.full.get(self.owner[v])
                if items:
                    found |= items
                    reach = self.n
            for m, item in self.short.get(v, ()):
                if m <= have:
                    found.add(item)
                    reach = max(reach, m)
            if reach:
                hits.append((start + i + 1 - reach, start + i + 1))
        return hits, longest
