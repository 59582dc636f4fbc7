"""Hashes of byte ranges, computed for a whole text at a time."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly (the splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        values = values + np.uint64(0x9E3779B97F4A7C15)
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def _grow(size: int) -> None:
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, 2 * len(_powers))
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _BASE)]))
            _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse)]))


class RangeHash:
    """64-bit hashes of any ranges of ``data``: equal bytes give equal hashes."""

    def __init__(self, data: bytes):
        _grow(len(data) + 1)
        with np.errstate(over="ignore"):
            terms = _TABLE[np.frombuffer(data, np.uint8)] * _powers[: len(data)]
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(terms)])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * _inverses[starts])


def shingles(text: str, size: int) -> np.ndarray:
    """A hash per window of ``size`` words (in order, repeats kept).

    Fewer words are one shingle; no word is no shingle.
    """
    words = text.encode().split()
    if not words:
        return np.empty(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - size + 1)
    return RangeHash(b" ".join(words))(starts[:last], ends[len(ends) - last :])
