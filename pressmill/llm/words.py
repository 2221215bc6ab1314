"""Words of byte texts as arrays: where they stand, and a hash of each."""

import numpy as np

from .anchors import BYTE_SYMBOLS, Rolling, U

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and for each text the number of its first word (and the total)."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at_once: int = 1 << 18) -> np.ndarray:
    """A hash of each word, made for so many of them at once that a giant text needs no giant tables."""
    out = np.zeros(len(starts), dtype=U)
    for lo in range(0, len(starts), at_once):
        part = slice(lo, lo + at_once)
        base = starts[lo]
        out[part] = Rolling(BYTE_SYMBOLS[data[base : ends[part][-1]]]).spans(starts[part] - base, ends[part] - base)
    return out
