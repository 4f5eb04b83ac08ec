"""Vectorised 64-bit hashes of words, word shingles and character shingles."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: An odd number and its inverse modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ORDER = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTH = _ORDER[-1] * np.arange(64, dtype=np.uint64)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS = tuple(np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, b, np.uint64))])
                        for b in (_BASE, _INVERSE))
    return _POWERS


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """``out[i]``: polynomial hash of the first ``i`` bytes, modulo 2**64."""
    up, _ = _powers(len(raw))
    out = np.empty(len(raw) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE[raw] * up[:len(raw)], out=out[1:])
    return out


def spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; equal bytes hash alike wherever they stand."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of bytes that end in white space."""
    space = _SPACE[raw]
    inside = ~space
    return np.flatnonzero(inside & np.concatenate([[True], space[:-1]])), np.flatnonzero(space & np.concatenate([[False], inside[:-1]]))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash per word (A-Z in lower case, words parted by ASCII white space) of all texts, and the
    number of words before each text (one more entry than texts)."""
    raw = [(t or "").encode().translate(LOWER) for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    a = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    start, end = word_bounds(a)
    hashes = spans_hash(prefix_sums(a), start, end) if len(start) else np.zeros(0, np.uint64)
    return hashes, np.concatenate([[0], np.searchsorted(start, ends)])


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a short word sequence as a whole (fewer words than ``_ORDER`` holds)."""
    return mix((words * _ORDER[:len(words)]).sum(keepdims=True) + _LENGTH[len(words)])[0]


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text: ``size`` consecutive words, or the whole
    sequence where there are fewer, or none."""
    words, at = word_hashes(texts)
    n = len(words) - size + 1
    if n > 0:
        sums = words[:n] * _ORDER[0]
        for j in range(1, size):
            sums = sums + words[j:j + n] * _ORDER[j]
        runs = mix(sums + _LENGTH[size])
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= size:
            s = np.sort(runs[a:b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(np.array([sequence_hash(words[a:b])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.astype(np.uint64, copy=False).view(np.int64)
