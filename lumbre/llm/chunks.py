"""Token ids of many texts from the ids of their distinct chunks.

A chunk is what stands between single spaces or line breaks; byte-level tokenizers of this kind always begin a new
piece there, so a text's ids are those of its chunks in a row. Texts with other white space, with runs of it, or
with a special token are encoded whole. Chunks met before are looked up; when the store is full, those used least are
forgotten, so its memory is bounded.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np

Encoded = tuple[np.ndarray, np.ndarray]  # flat ids, number of ids per text

#: Chunks and characters at which the least used half of the store is forgotten.
KEPT, KEPT_CHARS = 800_000, 24_000_000

_ASCII = np.zeros(256, bool)
_ASCII[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def other_space(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each text whether it may hold white space other than blanks and line feeds."""
    base = int(offsets[0])
    at = np.flatnonzero(_ASCII[data[base : int(offsets[-1])]]) + base
    lead = data[at]
    after = data[np.minimum(at + 1, len(data) - 1)]
    hit = (lead < 0x80) | ((lead == 0xC2) & ((after == 0x85) | (after == 0xA0)))
    hit |= ((lead == 0xE1) & (after == 0x9A)) | ((lead == 0xE2) & ((after == 0x80) | (after == 0x81)))
    hit |= (lead == 0xE3) & (after == 0x80)
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, at[hit], "right") - 1] = True
    return out


class _Numbers(dict):
    """Numbers for chunks; a new chunk is put on the list of those to encode."""

    def __init__(self, owner: Chunks, prefix: str):
        super().__init__()
        self.owner, self.prefix = owner, prefix

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self.owner.counts) + len(self.owner.fresh)
        self.owner.fresh.append(self.prefix + key)
        self.owner.chars += len(key)
        return number


class Chunks:
    """Encodes texts through ``encode``, which gives the ids of whole texts."""

    def __init__(self, encode: Callable[[list[str]], Encoded], special: tuple[str, ...] = ()):
        self.encode, self.special = encode, special
        self.clear()

    def clear(self) -> None:
        """Forget all chunks, to leave a worker's memory to other work."""
        self.fresh: list[str] = []
        self.bare, self.spaced = _Numbers(self, ""), _Numbers(self, " ")
        self.counts = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        self.chars = 0

    def _forget(self) -> None:
        """Keep the most used half of the chunks, numbered anew."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: KEPT // 2])
        keep = keep[np.cumsum(self.counts[keep]) <= KEPT_CHARS // 2]
        number = np.full(len(self.counts), -1)
        number[keep] = np.arange(len(keep))
        size = self.counts[keep]
        self.flat = self.flat[np.repeat(self.starts[keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        self.counts, self.starts, self.uses = size, np.cumsum(size) - size, self.uses[keep] // 2
        self.chars = 0
        for table in (self.bare, self.spaced):
            old = [(k, n) for k, v in table.items() if (n := int(number[v])) >= 0]
            table.clear()
            table.update(old)
            self.chars += sum(len(k) for k, _ in old)

    def _codes(self, text: str, codes: array) -> bool:
        """Add the chunk numbers of a text; False, and nothing added, where it must be encoded whole."""
        mark = len(codes)
        for k, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if "" in parts:
                del codes[mark:]
                return False
            if k:
                codes.append(self.bare["\n"])
            codes.append(self.bare[parts[0]])
            codes.extend(map(self.spaced.__getitem__, parts[1:]))
        return True

    def _learn(self) -> None:
        if self.fresh:
            flat, counts = self.encode(self.fresh)
            self.flat = np.concatenate([self.flat, flat])
            self.counts = np.concatenate([self.counts, counts])
            self.starts = np.cumsum(self.counts) - self.counts
            self.uses = np.concatenate([self.uses, np.zeros(len(counts), np.int64)])
            self.fresh = []

    def ids(self, texts: list[str], odd: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text in turn. ``odd``: which texts have other white space."""
        if len(self.counts) > KEPT or self.chars > KEPT_CHARS:
            self._forget()
        codes, ends, whole = array("i"), [], []
        for text, strange in zip(texts, odd.tolist(), strict=True):
            if text and (strange or any(s in text for s in self.special) or not self._codes(text, codes)):
                whole.append(len(ends))
            ends.append(len(codes))
        self._learn()
        numbers = np.frombuffer(codes, np.int32) if codes else np.zeros(0, np.int32)
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        flat, counts = self.encode([texts[k] for k in whole]) if whole else (self.flat, np.zeros(0, np.int64))
        stops = np.cumsum(counts)
        apart = {k: flat[stop - n : stop] for k, stop, n in zip(whole, stops.tolist(), counts.tolist(), strict=True)}
        begin = 0
        for k, end in enumerate(ends):
            if k in apart:
                yield apart[k]
            else:
                own = numbers[begin:end]
                size = self.counts[own]
                stop = np.cumsum(size)
                shift = np.repeat(self.starts[own] - (stop - size), size)
                yield self.flat[shift + np.arange(len(shift))]
            begin = end
