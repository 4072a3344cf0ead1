"""Rolling hashes of byte arrays in numpy: the hash of any stretch from two prefix sums."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, 256, dtype=np.uint64)
#: How many powers a worker keeps (longer texts make theirs).
KEPT = 1 << 21
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept between calls up to KEPT."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(-(-n // 65536) * 65536, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    if len(made[0]) <= KEPT:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of the stretches of ``data`` (uint8); equal bytes, equal hashes, wherever they stand."""

    def __init__(self, data: np.ndarray) -> None:
        power, self._inverse = _power(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        terms = _TABLE[data]
        terms *= power[:-1]
        np.cumsum(terms, out=self._sums[1:])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._inverse[start] + (stop - start).astype(np.uint64))


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive entries of ``hashes``."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix(out)
