"""Words of UTF-8 bytes and their hashes, for a whole block of texts at once."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (three xor-shift and multiply steps)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown as longer blocks come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            grow = lambda base: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))
            self.up, self.down = grow(_BASE), grow(pow(_BASE, -1, 1 << 64))
        return self.up, self.down


_POWERS = Powers()


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and each text's first word (one more entry at the end).

    Words are runs of bytes outside 0x20 and 0x09-0x0D that stay inside a text.
    """
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z taken as a-z: a polynomial of its bytes, mixed with its length."""
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix(mix((sums[ends] - sums[starts]) * down[starts]) + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive words; with fewer words, of the whole sequence as one."""
    if not len(words):
        return words
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = mix(out + words[j:len(words) - k + 1 + j])
    return out
