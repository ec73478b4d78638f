"""Sets of word shingles as 64-bit hashes, worked out for many texts at once."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Shingler:
    """Distinct shingles of texts: A-Z lower-cased, words between ASCII white space.

    Words are hashed as differences of one running sum over the joined bytes. A text of fewer than
    ``k`` words has its whole sequence as one shingle, a text without words none.
    """

    def __init__(self, k: int = SHINGLE_WORDS):
        self.k = k
        self._up = self._down = np.zeros(0, np.uint64)

    def sets(self, data: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct hashes of each text."""
        if not data:
            return []
        joined = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
        n = len(joined)
        if len(self._up) < n + 1:
            self._up, self._down = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        joined = _LOWER[joined]
        space = _SPACE[joined]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
            (joined.astype(np.uint64) + np.uint64(1)) * self._up[:n])))
        words = mix((sums[ends] - sums[starts]) * self._down[starts]
                    + (ends - starts).astype(np.uint64))
        text_ends = np.cumsum([len(t) + 1 for t in data])
        firsts = np.searchsorted(starts, np.concatenate(([0], text_ends)))
        k = self.k
        long = max(0, len(words) - k + 1)
        shingles = np.zeros(long, np.uint64)
        for j in range(k):
            shingles += mix(words[j:j + long], j + 1)
        shingles = mix(shingles)
        out = []
        for a, b in zip(firsts[:-1], firsts[1:]):
            if b - a >= k:
                out.append(np.unique(shingles[a:b - k + 1]))
            elif b > a:
                parts = [mix(words[a + j:a + j + 1], 100 * int(b - a) + j) for j in range(b - a)]
                out.append(mix(np.sum(parts, axis=0)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def grouped(values: list[str], size: int = 1 << 18):
    """Texts as bytes in runs that hold about ``size`` characters together, with their places."""
    group, first, n = [], 0, 0
    for i, v in enumerate(values):
        group.append(v.encode())
        n += len(v)
        if n >= size:
            yield first, group
            group, first, n = [], i + 1, 0
    if group:
        yield first, group
