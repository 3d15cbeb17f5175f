"""64-bit hashes of any stretch of a byte array, by prefix sums of a polynomial."""

from __future__ import annotations

import numpy as np

_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 1 << 64)
#: A fixed random value for each byte.
_VALUES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
_VALUES += np.random.default_rng(20260102).integers(0, 2, 256, dtype=np.uint64)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, n at least."""
    if len(_powers[0]) < n:
        for k, factor in enumerate((_STEP, _INVERSE)):
            steps = np.full(max(n, 1 << 20), factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Stretches:
    """Hashes of ``data[start:end]`` that depend on the bytes alone."""

    def __init__(self, data: np.ndarray):
        powers, self._back = _grown(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * powers[: len(data)], out=self._sums[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._back[starts])


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words end before each text.

    ``starts`` has where each text starts, and the end of the last; a word never
    crosses it."""
    solid = np.zeros(len(data) + 2, bool)
    np.logical_not(_BLANK[data], out=solid[1:-1])
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begins = solid[1:] & (~solid[:-1] | edge)
    ends = solid[:-1] & (~solid[1:] | edge)
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends), np.searchsorted(first, starts)
