"""CRC-32C of many byte strings at once, and the masked form that record files use."""

from __future__ import annotations

import numpy as np

_POLYNOMIAL = 0x82F63B78  # Castagnoli, reflected: fixed by the checksum's definition
_MASK = 0xA282EAD8  # fixed by the record format
_CHUNK = 512


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_BYTE = _byte_table()
_low = _BYTE[np.arange(65536) & 255]
_PAIR = _BYTE[(_low ^ (np.arange(65536, dtype=np.uint32) >> 8)) & 255] ^ (_low >> 8)


def _zeros(x: np.ndarray) -> np.ndarray:
    return _BYTE[x & 255] ^ (x >> 8)


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def _shifts(levels: int) -> list[np.ndarray]:
    """For k < levels the tables that push a checksum over 2 ** k zero bytes; the step is linear over bits."""
    out = []
    step = _zeros
    for _ in range(levels):
        tables = np.stack([step(np.arange(256, dtype=np.uint32) << np.uint32(8 * b)) for b in range(4)])
        out.append(tables)
        step = lambda x, t=tables: _apply(t, _apply(t, x))
    return out


_SHIFT = _shifts(32)


def crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksums of the stretches [starts, ends) of ``data``."""
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    sizes = ends - starts
    chunks = -(-sizes // _CHUNK)
    stops = np.cumsum(chunks) * _CHUNK
    padded = np.zeros(int(stops[-1]) if len(stops) else 0, np.uint8)
    for stop, start, end in zip(stops.tolist(), starts.tolist(), ends.tolist(), strict=True):
        padded[stop - (end - start) : stop] = data[start:end]
    level = _PAIR[padded.view(np.uint16)].reshape(-1, _CHUNK // 2)
    for k in range(1, _CHUNK.bit_length() - 1):
        level = _apply(_SHIFT[k], level[:, 0::2]) ^ level[:, 1::2]
    level = level.reshape(-1)
    out = np.zeros(len(sizes), np.uint32)
    first = stops // _CHUNK - chunks
    order = np.argsort(-chunks, kind="stable")
    live = chunks[order]
    for j in range(int(live[0]) if len(live) else 0):
        own = order[: np.searchsorted(-live, -j, "left")]
        out[own] = _apply(_SHIFT[_CHUNK.bit_length() - 1], out[own]) ^ level[first[own] + j]
    begin = np.full(len(sizes), 0xFFFFFFFF, np.uint32)
    for k in range(int(sizes.max(initial=0)).bit_length()):
        bit = (sizes >> k) & 1 == 1
        begin[bit] = _apply(_SHIFT[k], begin[bit])
    return out ^ begin ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Checksums turned by 15 bits and offset, so that data that holds checksums is checked soundly."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)
