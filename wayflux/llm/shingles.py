"""Word shingle sets of whole texts as 64-bit hashes, a batch of texts at a time in numpy.

Words are what stands between the white space characters space and tab to carriage return, with
A-Z lower-cased.  A text of fewer words than a shingle has its whole sequence as one shingle; a
null text or one without words has an empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_SLICE_BYTES = 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Polynomial hashes modulo 2^64 of all words of a buffer from one running sum."""

    def __init__(self) -> None:
        lower = np.arange(256, dtype=np.uint64)
        lower[65:91] += np.uint64(32)
        self._letter = mixed(lower * _ODD + np.uint64(77))
        self._space = np.zeros(256, dtype=bool)
        self._space[[32, 9, 10, 11, 12, 13]] = True
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and of each text (given by its start and the end) the first word's
        position in them; one position more than texts."""
        n = len(data)
        if n >= len(self._up):
            self._up = _powers(_BASE, n + 1)
            self._down = _powers(pow(_BASE, -1, 2**64), n + 1)
        space = np.empty(n + 2, dtype=bool)
        space[0] = space[-1] = True
        space[1:-1] = self._space[data]
        first = np.zeros(n + 1, dtype=bool)
        first[starts] = True
        begin = np.flatnonzero(~space[1:-1] & (space[:-2] | first[:-1]))
        end = np.flatnonzero(~space[1:-1] & (space[2:] | first[1:])) + 1
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self._letter[data] * self._up[:n], out=total[1:])
        hashes = mixed((total[end] - total[begin]) * self._down[begin])
        return hashes, np.searchsorted(begin, starts)


def shingle_sets(texts: pa.Array, size: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    flat = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[
        flat.offset:flat.offset + len(flat) + 1]
    raw = flat.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(flat):
        to = int(np.searchsorted(offsets, offsets[at] + _SLICE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), len(flat))
        part = data[offsets[at]:offsets[to]]
        words, first = hasher.words(part, offsets[at:to + 1] - offsets[at])
        rolled = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
        for k in range(size):
            rolled += words[k:k + len(rolled)] * np.uint64(pow(int(_ODD), k + 1, 2**64))
        rolled = mixed(rolled)
        for k in range(to - at):
            a, b = int(first[k]), int(first[k + 1])
            if a == b:
                yield np.zeros(0, dtype=np.uint64)
            elif b - a < size:
                h = np.array([b - a], dtype=np.uint64)
                for k_word in range(a, b):
                    h = mixed(h * _ODD + words[k_word])
                yield h
            else:
                s = np.sort(rolled[a:b - size + 1])
                keep = np.ones(len(s), dtype=bool)
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
        at = to
