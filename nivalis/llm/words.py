"""Hashes of the words of a text, in numpy."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(77)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**61)) * 8 + 3
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at once.
SLICE = 1 << 18


def _powers(base: int) -> np.ndarray:
    steps = np.full(SLICE + 1, np.uint64(base))
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x ^= x >> np.uint64(29)
    return x * _MIX


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ in bytes."""
    gap = np.concatenate([[True], _SPACE[data], [True]])
    return np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])


def _sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWER[: len(data)], out=out[1:])
    return out


def slice_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice start..end of bytes; slices rise and don't overlap."""
    out, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        at = start[i]
        j = int(np.searchsorted(end, at + SLICE, "right"))
        if j > i:
            sums = _sums(data[at : end[j - 1]])
            out[i:j] = (sums[end[i:j] - at] - sums[start[i:j] - at]) * _INVERSE[start[i:j] - at]
        else:  # one word that is longer than a slice
            j, total = i + 1, 0
            for part in range(int(at), int(end[i]), SLICE):
                total += int(_sums(data[part : min(part + SLICE, end[i])])[-1]) * pow(_BASE, part - int(at), 2**64)
            out[i] = total % 2**64
        i = j
    return mix(out)


def word_hashes(text: bytes | memoryview) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return slice_hashes(data, *word_bounds(data))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n words in a row."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out + words[i : len(words) - n + 1 + i])
    return out
