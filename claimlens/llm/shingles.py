"""Word shingles of a text as 64-bit hashes, computed on whole arrays."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_RANDOM = np.random.default_rng(20240229)  # fixed: hashes must agree between tasks
_BYTE = _RANDOM.integers(1 << 63, size=256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_PLACE = _RANDOM.integers(1 << 63, size=WORDS + 1, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as many as the longest text so far needs."""
    if len(_powers[0]) < size:
        size = 1 << size.bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _MIX
    x = (x ^ x >> np.uint64(32)) * _MIX
    return x ^ x >> np.uint64(32)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of fewer words, one hash of them all; of none, nothing.

    Words are runs of anything but blanks (20 and 09 to 0D); A-Z count as a-z.
    """
    raw = _LOWER[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)]
    inside = np.concatenate([[False], ~_GAP[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    power, inverse = _power(len(raw))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * power[: len(raw)])])
    words = _mixed((sums[ends] - sums[starts]) * inverse[starts])
    n = len(words)
    if n < WORDS:
        return _mixed((words * _PLACE[:n]).sum(keepdims=True) + _PLACE[WORDS:] * np.uint64(n))
    joined = words[: n - WORDS + 1] * _PLACE[0]
    for k in range(1, WORDS):
        joined = joined + words[k : n - WORDS + 1 + k] * _PLACE[k]
    return np.unique(_mixed(joined))


def signature(shingles: np.ndarray) -> int:
    """A number for the whole set; equal sets have the same."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray) -> bytes:
    """Token bitmap, at least two bits to a token, so wide that halves can be folded onto each other."""
    width = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[((shingles * np.uint64(_BASE)) >> np.uint64(24)) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()
