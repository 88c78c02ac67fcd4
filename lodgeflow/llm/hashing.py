"""Vectorised hashing of many texts at once.

Texts of a batch lie in one byte buffer; sums of random byte values times powers of an
odd number, modulo 2**64, give the hash of any stretch from two prefix sums.  Hashes do
not depend on where a stretch lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


class Hasher:
    """Byte values and the powers of ``BASE`` and of its inverse, grown on demand."""

    def __init__(self, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.values = rng.integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                powers = np.full(size, np.uint64(base), np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums, one longer than ``values``."""
        self.grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out

    def stretch(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.down[starts])

    def windows(self, sums: np.ndarray, length: int) -> np.ndarray:
        """The hash of each stretch of ``length``, by its start."""
        n = len(sums) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((sums[length:] - sums[:n]) * self.down[:n])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts, without nulls, and the n + 1 bounds of each."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def to_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 bounds of each text in words."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~is_space()[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    before[cuts] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[cuts[cuts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(hasher: Hasher, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                lower: bool = False) -> np.ndarray:
    values = hasher.values[to_lower()] if lower else hasher.values
    return hasher.stretch(hasher.sums(values[data]), starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values from a place on; the last ones see fewer."""
    out, span = values.copy(), 1
    while span < width:
        step = min(span, width - span)
        np.minimum(out[:-step], out[step:], out=out[:-step]) if len(out) > step else None
        span += step
    return out


def sliding_max_back(values: np.ndarray, width: int) -> np.ndarray:
    """Maximum of each ``width`` values up to a place; the first ones see fewer."""
    out, span = values.copy(), 1
    while span < width:
        step = min(span, width - span)
        if len(out) > step:
            np.maximum(out[step:], out[:-step].copy(), out=out[step:])
        span += step
    return out


class Anchors:
    """Window minima over one batch: ``least[j]`` for each window of ``window`` units that
    starts at j inside one text (``valid``), over the hashes of its ``gram``-unit stretches."""

    def __init__(self, hasher: Hasher, sums: np.ndarray, bounds: np.ndarray, window: int, gram: int):
        n = len(sums) - 1
        self.width = window - gram + 1
        grams = np.full(n, MASK, np.uint64)
        made = hasher.windows(sums, gram)
        grams[:len(made)] = np.maximum(made, np.uint64(1))
        self.grams = grams
        room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
        self.valid = room >= window
        self.least = sliding_min(grams, self.width)

    def chosen(self) -> np.ndarray:
        """Places of the grams that are the least of some valid window."""
        seen = sliding_max_back(np.where(self.valid, self.least, np.uint64(0)), self.width)
        return np.flatnonzero(seen == self.grams)
