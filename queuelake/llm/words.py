"""Words and five-word shingles of whole texts as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D in the UTF-8
text.  Words are represented by 64-bit hashes taken from the prefix sums of a
polynomial over the bytes, so a text of any length costs a fixed number of
array passes and no Python loop per word.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_POWERS = _INVERSE = np.ones(1, dtype=np.uint64)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < size, at least."""
    global _POWERS, _INVERSE
    if len(_POWERS) < size:
        n = max(size, 2 * len(_POWERS), 1 << 16)
        steps = np.ones((2, n), dtype=np.uint64)
        steps[:, 1:] = np.array([[_BASE], [_STEP]], dtype=np.uint64)
        _POWERS, _INVERSE = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _POWERS, _INVERSE


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(text: str | None, lower: bool) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.lower() if lower else data


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The byte array, and the start and end offsets of its words."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=bool)
    np.logical_not(_SPACE[b], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return b, edge[0::2], edge[1::2]


def span_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``b[start:end]``; equal spans, equal hashes."""
    power, inverse = _powers(len(b) + 1)
    prefix = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * power[: len(b)], out=prefix[1:])
    value = (prefix[end] - prefix[start]) * inverse[start]
    return mix64(value + (end - start).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    b, start, end = word_bounds(data)
    return span_hashes(b, start, end) if len(start) else np.zeros(0, dtype=np.uint64)


def window_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Order-sensitive hash of every run of ``size`` words; empty if fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n])
    return out


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct five-word shingles of the lower-cased (A-Z) text.

    Fewer than five words: the whole sequence is one shingle.  No words or a
    null text: the empty set.
    """
    words = word_hashes(as_bytes(text, lower=True))
    if len(words) == 0:
        return words
    if len(words) < SHINGLE_WORDS:
        return window_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(window_hashes(words))
