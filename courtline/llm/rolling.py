"""Polynomial hashes over byte arrays (numpy, mod 2^64)."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_tables: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def tables(n: int) -> list[np.ndarray]:
    """Powers of the base up to ``n``, of its inverse, and a value for each byte."""
    if not _tables or len(_tables[0]) <= n:
        size = max(n, 1 << 16)
        _tables[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64))))
                      for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        _tables.append(mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)))
    return _tables


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """sums[j] - sums[i], times the inverse power i, is the hash of bytes i to j."""
    up, _, value = tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value[data] * up[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, first, end) -> np.ndarray:
    """Hash of the bytes from ``first`` to ``end`` (arrays or slices of one length)."""
    return mixed((sums[end] - sums[first]) * tables(len(sums) - 1)[1][first])


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of each word (run without ASCII white space) of ``text``, A-Z in lower case."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    inner = np.zeros(len(data) + 2, np.int8)
    inner[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inner))
    first, end = edges[::2], edges[1::2]
    sums = prefix_sums(data)
    return mixed(span_hashes(sums, first, end) + (end - first).astype(np.uint64))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles; fewer words are one shingle, none is an empty set."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(words, len(h))):
        out = mixed(out * np.uint64(_BASE) + h[i:i + n])
    return np.unique(out)
