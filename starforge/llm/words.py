"""Words of whole texts as numpy arrays.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, which in UTF-8 is
the same as a run of code points outside these. Words become 64-bit hashes: a
polynomial over random byte values modulo 2**64, then a mixing step.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_VALUE = _RNG.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_VALUE = _VALUE.copy()
_LOWER_VALUE[65:91] = _VALUE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


class Words(NamedTuple):
    data: np.ndarray    # bytes of all texts, a line feed between two
    begin: np.ndarray   # first byte of each text, and the end
    start: np.ndarray   # first byte of each word
    end: np.ndarray
    doc: np.ndarray     # text of each word
    hash: np.ndarray


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words_of(texts: list[str], lower: bool = False) -> Words:
    """All words of all texts; ``lower`` folds A-Z."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    begin = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=begin[1:])
    inside = ~SPACE[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(begin, start, "right") - 1
    value = (_LOWER_VALUE if lower else _VALUE)[data]
    value *= _powers(_BASE, len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    back = _powers(_BACK, len(data) + 1)
    h = mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))
    return Words(data, begin, start, end, doc, h)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words inside one text; entry k
    starts at word k of ``np.flatnonzero(same)`` order, which is returned by
    ``window_starts``."""
    at = window_starts(w, size)
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w.hash[at + k])
    return w.doc[at], h


def window_starts(w: Words, size: int) -> np.ndarray:
    n = len(w.doc) - size + 1
    return np.flatnonzero(w.doc[:n] == w.doc[size - 1:]) if n > 0 else np.zeros(0, np.int64)


def per_text(w: Words, flags: np.ndarray) -> np.ndarray:
    """Number of set bytes per text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[np.minimum(w.begin[1:] - 1, len(flags))] - total[w.begin[:-1]]
