"""Vectorised 64-bit hashes of byte ranges, words of whole texts, and requests between shards and buckets."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(2)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    return _powers(1 << max(16, int(n).bit_length()), base)[: n + 1]


class Ranges:
    """Hashes of any byte range [a, b) of data: equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n)[:n], out=self.sums[1:])
        self.back = powers(n, _INVERSE)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, short: int = 64) -> np.ndarray:
    """Hashes of byte ranges; those over short bytes by XXH64. A polynomial modulo 2^64, as Ranges has it, gives some long
    strings of a regular build (Thue-Morse words of 512 bytes and more) equal hashes whatever its base."""
    out = Ranges(data)(starts, ends)
    for i in np.flatnonzero(ends - starts > short).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), 7)
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: bytes between white space (0x20, 0x09 to 0x0D), never across rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1
