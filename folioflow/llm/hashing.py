"""Vectorised hashes over byte buffers.  They only sort, sample and pre-select; equality is decided on bytes."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_cache: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _cache.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        made = np.full(size, base, dtype=np.uint64)
        made[0] = 1
        np.cumprod(made, out=made)
        if size <= 1 << 20:
            _cache[int(base)] = made
        have = made
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """Hashes of any spans of one sequence from prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.inverse = _powers(_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def fixed(self, width: int) -> np.ndarray:
        """Of every span of the given width, in order."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts; offs are the texts' bounds in buf."""
    solid = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offs] = True
    before = np.empty(len(buf), dtype=bool)
    before[:1] = True
    before[1:] = ~solid[:-1]
    start = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(buf), dtype=bool)
    after[-1:] = True
    after[:-1] = ~solid[1:]
    return start, np.flatnonzero(solid & (after | edge[1:])) + 1


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of the given width."""
    if len(a) < width:
        return a[:0]
    span = 1
    while span * 2 <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return a if span == width else np.minimum(a[: len(a) - (width - span)], a[width - span :])


def anchors(order: np.ndarray, bounds: np.ndarray, window: int, choices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows that share the leftmost least place among their first ``choices`` places.

    order: a hash for each place; bounds: the documents' bounds in units; a window has ``window`` units of
    one document.  Returns the first and the last window start and the place of each run.
    """
    none = np.zeros(0, dtype=np.int64)
    low = np.uint64(0xFFFFFFFF)
    least = sliding_min((order & ~low) | np.arange(len(order), dtype=np.uint64), choices)
    whole = np.zeros(len(least), dtype=bool)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= window:
            whole[a : b - window + 1] = True
    at = np.flatnonzero(whole)
    if not len(at):
        return none, none, none
    place = (least[at] & low).astype(np.int64)
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], place[first]
