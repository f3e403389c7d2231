"""Text columns as numpy arrays: bytes of a batch, slices of bounded size, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in slices of about so many bytes (a longer text is a slice of its own).
SLICE = 1_000_000


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return offsets.astype(np.int64), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the hash base and of its inverse."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS[0][:n], _POWERS[1][:n]


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums of value * base ** position, from which any stretch is hashed by ``stretch``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def stretch(running: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [first, last): equal stretches have equal hashes wherever they stand."""
    return mixed((running[last] - running[first]) * powers(len(running))[1][first] + (last - first).astype(np.uint64))


_RANDOM = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_IS_WORD = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)])


def byte_values(data: np.ndarray) -> np.ndarray:
    """A random 64-bit number for each byte."""
    return _RANDOM[data]


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a slice in order, and where each text's words begin (one more at the end).

    A-Z count as a-z. A word is a run of characters other than ASCII ones that are neither letter nor digit;
    in UTF-8 that can be told byte by byte. Two different words share a hash with a chance of 2 ** -64.
    """
    base = int(offsets[0])
    data, offsets = data[base : int(offsets[-1])], offsets - base
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[1:-1][cuts]
    before = cuts[cuts > 0] - 1
    ends[before] = inside[1:-1][before]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = stretch(sums(_RANDOM[_LOWER[data]]), first, last)
    return hashes, np.searchsorted(first, offsets)
