"""Shingle hashes, 64-bit fingerprints and the ring's budgets, shared by the two ways of linking of operator 10."""

from __future__ import annotations

import numpy as np
import xxhash

from folioflow.llm.hashing import mix, word_spans

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; a text of fewer words is one shingle, one without words has none."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    start, stop = (x.tolist() for x in word_spans(np.frombuffer(joined, dtype=np.uint8), np.array([0, len(joined)])))
    n, digest = max(1, len(words) - width + 1), xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(start[:n], stop[min(width, len(words)) - 1 :], strict=True)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes; zero without any."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        block = hashes[i : i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def budgets(segments: int, distance: int) -> list[int]:
    """Differences allowed in the first l segments of a chain, for l = 0 to all."""
    return [n * distance // segments for n in range(segments + 1)]


def bounds(segments: int) -> list[tuple[int, int]]:
    """Shift and width of each segment."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


#: The wide fingerprint: words of 64 bits, the first from the hashes themselves, all cut in a ring of 16-bit segments.
WORDS = 28
_STEPS = np.arange(WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def ring(hashes: np.ndarray) -> np.ndarray:
    """Segments of the wide fingerprint: bits set in over half the hashes, and in over half of each mix of them."""
    ones = np.zeros(WORDS * 64, dtype=np.int64)
    for i in range(0, len(hashes), 255):
        own = hashes[i : i + 255, None]
        mixed = mix(own + _STEPS)
        mixed[:, :1] = own
        ones += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes)).view(np.uint16)


def chains(segments: np.ndarray, length: int) -> np.ndarray:
    """Of each row of segments, the ``length`` of them that follow each one on the ring."""
    around = np.concatenate([segments, segments[:, :length]], axis=1)[:, 1:]
    return np.lib.stride_tricks.sliding_window_view(around, length, axis=1)


def keeps(differences: np.ndarray, most: list[int]) -> np.ndarray:
    """Whether a chain whose first segment is equal keeps each budget; differences: those of the segments after it."""
    return (np.cumsum(differences, axis=-1, dtype=np.int64) <= np.array(most[2 : 2 + differences.shape[-1]])).all(axis=-1)
