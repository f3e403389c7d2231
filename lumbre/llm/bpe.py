"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct pieces of a batch are laid out in one array of symbols. An index maps each pair that has a rank to all
its positions. Ranks are taken in ascending order; a rank is applied at all its positions at once, and the pairs to
the left and right of each merge go into the lists of their own ranks. Positions that a merge has overtaken are
found stale when their list is read.

Null and empty texts have no ids. The special tokens of the file are found in a text as the file says; nothing is
added. Very long pieces take part like short ones: the work grows with their length, not with its square.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import regex

#: How text is cut into pieces before merging: a fixed pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = regex.compile(PATTERN)


def printable_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file: a byte that is printable in
    Latin-1 stands for itself, the others follow from code point 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or (b >= 0xA1 and b != 0xAD)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Bpe:
    """A vocabulary with its merges, read from the text of a tokenizer file."""

    def __init__(self, source: str):
        file = json.loads(source)
        model, byte_of = file["model"], printable_bytes()
        vocabulary = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = max([*vocabulary.values(), *self.specials.values()]) + 1
        tokens = [b""] * size
        for token, number in vocabulary.items():
            if token not in self.specials:
                tokens[number] = bytes(byte_of[c] for c in token)
        for token, number in self.specials.items():
            tokens[number] = token.encode()
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_ids = np.zeros(256, np.int32)
        for char, byte in byte_of.items():
            self.byte_ids[byte] = vocabulary[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], np.int64)
        made = np.full(size, -1)
        made[self.merges[:, 2]] = np.arange(len(pairs))
        if (np.maximum(made[self.merges[:, 0]], made[self.merges[:, 1]]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge comes before one that makes its parts: ranks cannot be taken in order")
        code = (self.merges[:, 0] << 32) | self.merges[:, 1]
        self.rank_order = np.argsort(code)
        self.rank_codes = code[self.rank_order]
        marks = "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))
        self._special = regex.compile(f"({marks})") if marks else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where the pair has none."""
        code = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.rank_codes, code), len(self.rank_codes) - 1)
        return np.where(self.rank_codes[at] == code, self.rank_order[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbol = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbol)
        ends = np.cumsum(sizes)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        index = _PairIndex()
        start = np.flatnonzero(after >= 0).astype(np.int32)
        index.add(start, self.ranks(symbol[start], symbol[start + 1]))
        for rank, at in index:
            left, right, made = self.merges[rank].tolist()
            second = after[at]
            at = at[(symbol[at] == left) & (second >= 0) & (symbol[second] == right)]
            if left == right and len(at) > 1:
                at = _leftmost(at, after)
            second = after[at]
            third = after[second]
            symbol[at], symbol[second] = made, -1
            after[at] = third
            before[third[third >= 0]] = at[third >= 0]
            first = before[at]
            touched = np.concatenate([first[first >= 0], at[third >= 0]])
            index.add(touched, self.ranks(symbol[touched], symbol[after[touched]]))
        owner = np.repeat(np.arange(len(pieces)), sizes)[symbol >= 0]
        return symbol[symbol >= 0], np.bincount(owner, minlength=len(pieces))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and how many each has; equal pieces are merged once."""
        numbers: dict[str, int] = {}
        found: list[int] = []
        counts = []
        for text in texts:
            mark = len(found)
            for k, part in enumerate(self._special.split(text) if self._special else [text]):
                if k % 2:
                    found.append(-1 - self.specials[part])
                else:
                    found += [numbers.setdefault(p, len(numbers)) for p in _PIECES.findall(part)]
            counts.append(len(found) - mark)
        flat, sizes = self.encode_pieces([p.encode() for p in numbers])
        special = sorted(self.specials.values())
        flat = np.concatenate([flat, np.array(special, np.int32)])
        starts = np.append(np.cumsum(sizes) - sizes, np.arange(len(flat) - len(special), len(flat)))
        sizes = np.append(sizes, np.ones(len(special), np.int64))
        own = np.array(found, np.int64)
        own[own < 0] = len(numbers) + np.searchsorted(special, -1 - own[own < 0])
        size = sizes[own] if len(own) else np.zeros(0, np.int64)
        stop = np.cumsum(size)
        shift = np.repeat((starts[own] - (stop - size)) if len(own) else size, size)
        edges = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        return flat[shift + np.arange(len(shift))].astype(np.int32), np.diff(edges)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8; bytes that are no UTF-8 become the replacement character."""
        size = self.lengths[ids]
        stop = np.cumsum(size)
        shift = np.repeat(self.starts[ids] - (stop - size), size)
        return self.bytes[shift + np.arange(len(shift))].tobytes().decode("utf-8", "replace").encode()


class _PairIndex:
    """Positions by rank; iterating takes the lowest rank that has any, also those added meanwhile."""

    def __init__(self) -> None:
        self.lists: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def add(self, at: np.ndarray, ranks: np.ndarray) -> None:
        known = ranks >= 0
        at, ranks = at[known], ranks[known]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        edges = [0, *cuts.tolist(), len(at)]
        for rank, begin, end in zip(ranks[[0, *cuts]].tolist(), edges, edges[1:], strict=False):
            if rank not in self.lists:
                self.lists[rank] = []
                heapq.heappush(self.heap, rank)
            self.lists[rank].append(at[begin:end])

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        while self.heap:
            rank = heapq.heappop(self.heap)
            yield rank, np.unique(np.concatenate(self.lists.pop(rank)))


def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping places of a pair of equal symbols every other one, from the left."""
    linked = np.concatenate([[False], after[at[:-1]] == at[1:]])
    place = np.arange(len(at))
    run = np.maximum.accumulate(np.where(linked, 0, place))
    return at[(place - run) % 2 == 0]
