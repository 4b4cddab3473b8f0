"""An Elias-Fano trie of n-grams: contexts, monotone pointers, successors and quantised probabilities.

Level 1 holds the hashes of words, each further level the successors of the level before; a pointer sequence
gives each entry's range in the next level. A successor is stored as its parent's number and its own hash, which makes a whole
level one monotone sequence. All sequences are Elias-Fano coded and read through a memory map.
"""

from __future__ import annotations

import mmap

import numpy as np

#: Bits of a successor's hash, and of a context's.
SUCCESSOR_BITS, CONTEXT_BITS = 32, 62
#: A probability code c > 0 stands for 10 ** -((c - 1) * STEP); 0: not stored.
STEP = 12 / 254


def quantise(p: np.ndarray) -> np.ndarray:
    """Codes of probabilities, rounded down, so that sums stay below one."""
    return (np.clip(np.ceil(-np.log10(p) / STEP - 1e-9), 0, 254) + 1).astype(np.uint8)


def probability(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == 0, 0.0, 10.0 ** (-(codes.astype(np.float64) - 1) * STEP))


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary with counts for selection."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs, self.ranks = n, low_bits, lows, highs, ranks

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, min(56, (universe // max(n, 1)).bit_length() - 1))
        values = values.astype(np.uint64)
        lows = np.zeros(8, np.uint8)
        if low_bits and n:
            parts = []
            for i in range(0, n, 1 << 15):  # a multiple of 8 values, so that parts end on whole bytes
                bits = np.unpackbits(values[i : i + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - low_bits :]
                parts.append(np.packbits(bits.ravel()))
            lows = np.concatenate([*parts, lows])
        top = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((int(top[-1]) if n else 0) // 512 * 512 + 512, bool)
        flags[top] = True
        ranks = np.append(0, np.cumsum(flags.reshape(-1, 512).sum(axis=1))).astype(np.uint32)
        return cls(n, low_bits, lows, np.packbits(flags, bitorder="little"), ranks)

    def arrays(self) -> list[np.ndarray]:
        return [self.lows, self.highs, self.ranks]

    def tops(self) -> np.ndarray:
        """The high parts of all values."""
        return np.flatnonzero(np.unpackbits(self.highs, bitorder="little")) - np.arange(self.n)

    def low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        words = np.ndarray((len(self.lows) - 7,), ">u8", self.lows, strides=(1,))
        shift = (64 - self.low_bits - (bit & 7)).astype(np.uint64)
        return (words[bit >> 3].astype(np.uint64) >> shift) & np.uint64((1 << self.low_bits) - 1)


class Reader:
    """Access and successor search on one sequence; the high parts are unpacked for as long as it lives."""

    def __init__(self, coded: EliasFano):
        self.coded = coded
        self.top = coded.tops()
        self.starts = np.append(0, np.cumsum(np.bincount(self.top)))  # the first place of each high part

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.top[i].astype(np.uint64) << np.uint64(self.coded.low_bits)) | self.coded.low(i)

    def successor(self, keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The first place in [lo, hi) whose value is at least the key (hi: none), for all keys at once."""
        top = (keys >> np.uint64(self.coded.low_bits)).astype(np.int64)
        last = len(self.starts) - 1
        lo = np.maximum(lo, self.starts[np.minimum(top, last)])
        hi = np.maximum(lo, np.minimum(hi, self.starts[np.minimum(top + 1, last)]))
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            less = self[mid] < keys[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        return lo


class Trie:
    """Built from sorted contexts and, for each further level, the first places of its parents' ranges and its successors;
    fields are arrays by place of a level."""

    def __init__(self, contexts: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], fields: dict[str, np.ndarray]):
        self.n = parents = len(contexts)
        sequences = [EliasFano.encode(contexts, 1 << CONTEXT_BITS)]
        for first, successors in levels:
            bounds = np.append(first, len(successors)).astype(np.int64)
            owner = np.repeat(np.arange(parents, dtype=np.uint64), np.diff(bounds))
            sequences.append(EliasFano.encode(bounds, len(successors) + 1))
            sequences.append(EliasFano.encode(owner << np.uint64(SUCCESSOR_BITS) | successors.astype(np.uint64), max(parents, 1) << SUCCESSOR_BITS))
            parents = len(successors)
        arrays = self._mapped([a for s in sequences for a in s.arrays()] + list(fields.values()))
        read = [Reader(EliasFano(s.n, s.low_bits, *arrays[3 * i : 3 * i + 3])) for i, s in enumerate(sequences)]
        self.contexts, self.levels = read[0], list(zip(read[1::2], read[2::2]))
        self.fields = dict(zip(fields, arrays[3 * len(sequences) :]))

    @staticmethod
    def _mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
        """The arrays in one memory map of no file, which goes with its last reader: nothing is left in a machine's folders."""
        places = np.cumsum([0, *(a.nbytes + -a.nbytes % 8 for a in arrays)]).tolist()
        held = mmap.mmap(-1, max(places[-1], 8))
        for a, p in zip(arrays, places):
            held[p : p + a.nbytes] = a.tobytes()
        return [np.frombuffer(held, a.dtype, len(a), p) for a, p in zip(arrays, places)]

    def find_contexts(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of contexts (-1: none)."""
        if not self.n:
            return np.full(len(keys), -1)
        at = self.contexts.successor(keys, np.zeros(len(keys), np.int64), np.full(len(keys), self.n))
        inside = np.minimum(at, self.n - 1)
        return np.where((at < self.n) & (self.contexts[inside] == keys), inside, -1)

    def find(self, level: int, parents: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Places, in a level behind the contexts, of successors of numbered parents (-1: none)."""
        out = np.full(len(parents), -1)
        known = np.flatnonzero(parents >= 0)
        pointers, keys = self.levels[level]
        if len(known) and keys.coded.n:
            p = parents[known]
            asked = p.astype(np.uint64) << np.uint64(SUCCESSOR_BITS) | successors[known].astype(np.uint64)
            lo, hi = pointers[p].astype(np.int64), pointers[p + 1].astype(np.int64)
            at = keys.successor(asked, lo.copy(), hi)
            inside = np.minimum(at, keys.coded.n - 1)
            hit = (at < hi) & (keys[inside] == asked)
            out[known[hit]] = at[hit]
        return out
