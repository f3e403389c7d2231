"""A run-compressed Burrows-Wheeler index of a few texts, and the matching statistics read from it.

Suffixes are sorted by prefix doubling; every text ends in a separator of its own. Where neighbouring suffixes have
the same character before them, the characters stand in one run of the transform, and their common prefix is one
shorter than that of the suffixes one place to the left in the texts. So common prefixes are only measured at the ends
of runs, of which repetitive texts have few; streaming over the texts fills in the rest by counting down.
"""

from __future__ import annotations

import numpy as np

_FIRST = 7  # symbols of 9 bits in the first sort key


class RunIndex:
    """Index of texts given as one byte array and their lengths."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray):
        sizes = np.asarray(sizes, np.int64)
        ends = np.cumsum(sizes + 1) - 1
        self.starts = ends - sizes
        self.n = int(sizes.sum() + len(sizes))
        self.symbols = np.zeros(self.n + _FIRST, np.uint16)
        inside = np.ones(self.n, bool)
        inside[ends] = False
        self.symbols[: self.n][inside] = data.astype(np.uint16) + 1
        self._sort()
        self._runs()

    def _sort(self) -> None:
        """Suffix order, and for each doubling the ranks by so many symbols."""
        n = self.n
        key = np.zeros(n, np.uint64)
        broken = np.zeros(n, bool)
        for k in range(_FIRST):
            own = self.symbols[k : k + n]
            key = (key << np.uint64(9)) | np.where(broken, 0, own).astype(np.uint64)
            broken |= own == 0
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        # keys with a separator are distinct, in the order of the texts
        at = np.flatnonzero(broken[order])
        order[at] = order[at][np.lexsort((order[at], ordered[at]))]
        new[at] = True
        place = np.arange(n)
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, place, 0))
        self.levels = [(_FIRST, rank)]
        step = _FIRST
        while True:
            several = np.flatnonzero(~(new & np.append(new[1:], True)))
            if not len(several):
                break
            position = order[several]
            second = rank[np.minimum(position + step, n - 1)]
            pair = (rank[position].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
            by = np.argsort(pair)
            position, pair = position[by], pair[by]
            order[several] = position
            first = np.ones(len(pair), bool)
            first[1:] = pair[1:] != pair[:-1]
            new[several] = first
            rank = rank.copy()
            rank[position] = np.maximum.accumulate(np.where(first, several, 0))
            step *= 2
            self.levels.append((step, rank))
        self.order = order

    def _runs(self) -> None:
        """Heads and tails of the runs of the transform; each separator is a run by itself."""
        before = self.symbols[: self.n][self.order - 1]
        change = np.ones(self.n + 1, bool)
        change[1:-1] = (before[1:] != before[:-1]) | (before[1:] == 0) | (before[:-1] == 0)
        self.heads, self.tails = np.flatnonzero(change[:-1]), np.flatnonzero(change[1:])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        length = np.zeros(len(a), np.int64)
        last = self.n - 1
        for step, rank in reversed(self.levels):
            equal = rank[np.minimum(a + length, last)] == rank[np.minimum(b + length, last)]
            length += np.where(equal, step, 0)
        for _ in range(_FIRST - 1):
            one, two = self.symbols[np.minimum(a + length, last)], self.symbols[np.minimum(b + length, last)]
            going = (one == two) & (one > 0)
            if not going.any():
                break
            length += going
        return length

    def matching_statistics(self) -> np.ndarray:
        """For each place (separators included) the longest match that also starts at another place."""
        out = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for ends, other in ((self.heads, -1), (self.tails, 1)):
            own = ends[(ends + other >= 0) & (ends + other < self.n)]
            sampled, length = np.zeros(self.n, bool), np.zeros(self.n, np.int64)
            sampled[self.order[ends]] = True
            length[self.order[own]] = self.common(self.order[own], self.order[own + other])
            last = np.maximum.accumulate(np.where(sampled, place, 0))
            out = np.maximum(out, length[last] - (place - last))
        return out


def repeated_stretches(data: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """For each text its stretches, as rows (begin, end), covered by strings of ``least`` bytes that also start
    elsewhere in any of the texts."""
    index = RunIndex(data, sizes)
    hit = np.flatnonzero(index.matching_statistics() >= least)
    text = np.searchsorted(index.starts, hit, "right") - 1
    begin = hit - index.starts[text]
    out: list[np.ndarray] = [np.zeros((0, 2), np.int64)] * len(sizes)
    cuts = np.flatnonzero(np.diff(text)) + 1
    for own, at in zip(np.split(text, cuts), np.split(begin, cuts), strict=True):
        if len(own):
            out[int(own[0])] = merged(at, at + least)
    return out


def merged(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Stretches in order, those that touch or overlap made one."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    return np.stack([begin[first], end[last]], 1) if len(begin) else np.zeros((0, 2), np.int64)
