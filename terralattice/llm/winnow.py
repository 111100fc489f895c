"""Anchors of sequences: every window of fixed length chooses one by its content alone."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        both = np.stack([np.full(n, _BASE), np.full(n, _INVERSE)])
        both[:, 0] = 1
        np.cumprod(both, axis=1, out=both)
        _POWERS[n] = both[0], both[1]
    return _POWERS[n]


class Hashes:
    """Hashes of any part of a sequence of 64-bit symbols, in constant time each."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        powers, self.inverse = _powers(1 << max(12, n.bit_length()))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers[:n], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all `k` symbols in a row; the same as `of` gives."""
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:len(self.sums) - k])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def anchors(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: its position, first and last window.

    A window is `width` grams in a row; its anchor is the first of those smallest in
    their upper 32 bits. The lower bits carry the position through the minimum.
    """
    if len(grams) < width:
        none = np.zeros(0, np.int64)
        return none, none, none
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1  # `low` holds the smallest of `reach` grams from each position
    while reach < width:
        step = min(reach, width - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.concatenate((first[1:], [len(place)])) - 1
    return place[first], first, last
