"""Words, word shingles and MinHash signatures of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from eventgauge.llm.shared import mixed

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240101)
_BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_ORDER = _RNG.integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word and, for n texts, the n + 1 places where their words begin."""
    letters = np.flatnonzero(~SPACES[flat])
    if not len(letters):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    # A word begins where the byte before is white space or belongs to another text.
    text = np.searchsorted(offsets, letters, side="right")
    begins = np.ones(len(letters), bool)
    begins[1:] = (letters[1:] != letters[:-1] + 1) | (text[1:] != text[:-1])
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, len(letters)))
    inside = np.arange(len(letters)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    values = _BYTES[flat[letters]] * powers[inside]
    sums = np.add.reduceat(values, starts)
    bounds = np.searchsorted(letters[starts], offsets)
    return mixed(sums + lengths.astype(np.uint64)), bounds


def shingle_sets(flat: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `size` words.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    hashes, bounds = word_hashes(flat, offsets)
    n = len(hashes) - size + 1
    runs = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        runs += hashes[k : k + len(runs)] * _ORDER[k]
    runs = mixed(runs)
    out = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if last - first >= size:
            out.append(np.unique(runs[first : last - size + 1]))
        elif last > first:
            short = (hashes[first:last] * _ORDER[: last - first]).sum(dtype=np.uint64) + np.uint64(last - first)
            out.append(mixed(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class MinHash:
    """Signatures of `bands` times `rows` 32-bit minima."""

    def __init__(self, bands: int, rows: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = rng.integers(1, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.shifts = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
        self.mix = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(self.factors), 2**32 - 1, np.uint32)
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(short), 512):
            part = short[k : k + 512, None] * self.factors
            part += self.shifts
            # The high half of the product is the better mixed one; a rotation brings it up.
            part ^= part >> np.uint32(15)
            part *= np.uint32(0x85EBCA6B)
            np.minimum(out, part.min(axis=0), out=out)
        return out

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """One 64-bit key a band for each signature."""
        parts = signatures.reshape(-1, self.bands, self.rows).astype(np.uint64)
        sums = (parts * self.mix).sum(axis=2, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64)
        return mixed(sums).view(np.int64)
