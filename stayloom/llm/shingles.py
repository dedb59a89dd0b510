"""Word shingles of texts and their MinHash signatures, in numpy over the bytes of an Arrow batch.

Words are runs of bytes other than white space (0x20, 0x09-0x0D), lower-cased for A-Z. A text's set holds a 64-bit hash
of each run of SIZE words; a text of fewer words has one hash, of all its words; a text without words has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

SIZE = 5
_BYTES_AT_ONCE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240601)
_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_powers = {base: np.ones(1, np.uint64) for base in (_BASE, _BACK)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def runs_of(inside: np.ndarray, starts_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and last + 1 of each run of ``inside`` bytes; a run never reaches into the next text."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    own = starts_of[:-1][starts_of[:-1] < len(inside)]
    first[own] = inside[own]  # a text's first word starts there even if the one before ends without a blank
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    own = starts_of[1:-1][starts_of[1:-1] > 0] - 1
    last[own] = inside[own]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class SpanHashes:
    """Hash of any span of the bytes, lower-cased, in constant time."""

    def __init__(self, data: np.ndarray):
        self.summed = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[_LOWER[data]] * _power(_BASE, len(data)), out=self.summed[1:])
        self.back = _power(_BACK, len(data))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.summed[end] - self.summed[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def _word_hashes(data: np.ndarray, starts_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the number of words before each text."""
    begin, end = runs_of(~_SPACE[data], starts_of)
    return SpanHashes(data).of(begin, end), np.searchsorted(begin, starts_of)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The set of each text, as a sorted array."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(int(np.searchsorted(offsets, offsets[at] + _BYTES_AT_ONCE, "right")) - 1, at + 1)
        bounds = offsets[at:to + 1] - offsets[at]
        part = data[offsets[at]:offsets[to]]
        hashes, words = _word_hashes(part, bounds) if len(part) else (np.empty(0, np.uint64), np.zeros(to - at + 1, int))
        runs = len(hashes) - SIZE + 1
        grams = np.zeros(max(runs, 0), np.uint64)
        for k in range(SIZE):
            if runs > 0:
                grams += hashes[k:k + runs] * _PLACES[k]
        grams = _mixed(grams)
        for a, b in zip(words[:-1].tolist(), words[1:].tolist()):
            if b - a >= SIZE:
                yield np.unique(grams[a:b - SIZE + 1])
            elif b > a:
                yield _mixed((hashes[a:b] * _PLACES[:b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.empty(0, np.uint64)
        at = to


class MinHash:
    """Signatures of ``coordinates`` 32-bit minima."""

    def __init__(self, coordinates: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.multipliers = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.multipliers), 0xFFFFFFFF, np.uint64)
        for at in range(0, len(shingles), 4096):
            hashes = shingles[at:at + 4096, None] * self.multipliers + self.shifts
            least = np.minimum(least, (hashes >> np.uint64(32)).min(axis=0))
        return least.astype("<u4")


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()
