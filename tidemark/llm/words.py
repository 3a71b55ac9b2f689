"""Word hashes of many texts at once, as whole-array operations."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
_SYMBOL = _rng.integers(0, 2**64, 1024, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words that letters, digits and everything beyond ASCII form (after A-Z are lowered).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of words that white space separates.
SOLID = np.ones(256, dtype=bool)
SOLID[[32, 9, 10, 11, 12, 13]] = False

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << int(n - 1).bit_length()
        _powers, _inverse = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64))])
                             for b in (_BASE, _BASE_INV))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of an array of small numbers; equal spans have equal hashes."""
    _grow(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(_SYMBOL[symbols] * _powers[:len(symbols)], out=total[1:])
    return mix((total[ends] - total[starts]) * _inverse[starts])


def word_hashes(texts: list[bytes], word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text begins (one more entry than texts).

    A-Z count as a-z. Equal words have equal hashes wherever they stand.
    """
    buf = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    ends_at = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
    inside = word_bytes[buf]
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return span_hashes(buf, starts, ends), np.concatenate([[0], np.searchsorted(starts, ends_at)]).astype(np.int64)


def blocks(texts: list[bytes], most: int):
    """Slices of the list that hold about ``most`` bytes each; a longer text makes a slice of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))
