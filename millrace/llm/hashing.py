"""Vectorised hashing of bytes, words and windows with numpy; used inside tasks only.

A piece of text is hashed as a polynomial over the integers modulo 2**64 whose odd base can be inverted, so the
hash of any slice comes from two prefix sums. Every hash is mixed before use.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15
M64 = (1 << 64) - 1

#: ASCII white space: tab, line feed, vertical tab, form feed, carriage return and space.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Bytes hashed at once where a long text is read in steps; with it stay the powers that a worker keeps (4 MB) and the
#: arrays of a step small.
STEP = 1 << 17

#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def looked_up(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """``table[data]`` for a table of 256 bytes or booleans, without the eight bytes of index that numpy makes of each byte."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        out.append(powers)
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 at least of the base and of its inverse."""
    size = 1 << max(18, int(n - 1).bit_length())
    up, down = _powers(size)
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base**i; entry i covers the bytes before i."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Mixed hashes of the slices; equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def words_of(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are not ``space``, cut at the texts' ``bounds``, and for each text the
    number of words before it."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    word = ~looked_up(space, data)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = STEP) -> np.ndarray:
    """Hashes of the words, read in steps of about ``step`` bytes."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + step, side="right")))
        low = starts[at]
        sums = prefix_sums(data[low : ends[stop - 1]])
        out[at:stop] = slice_hashes(sums, starts[at:stop] - low, ends[at:stop] - low)
        at = stop
    return out


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mix(out + hashes[i : i + n])
    return out


def places_hash(data: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Mixed hashes of the ``width`` bytes from each start."""
    up, _ = powers(width)
    rows = np.lib.stride_tricks.sliding_window_view(data, width)[start].astype(np.uint64)
    rows += np.uint64(1)
    rows *= up[:width]
    return mix(rows.sum(axis=1))
