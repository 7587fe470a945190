"""Windows of a fixed length over bytes or words: hashes of any run, sliding minima, and runs of windows with one anchor."""

from __future__ import annotations

import numpy as np

from .common import BYTE_VALUES, INVERSE, U64, mix, powers

#: Low bits of a key that hold a position while minima are taken; longer arrays are taken in parts.
POSITION_BITS = 26


def sums_of(data: np.ndarray, base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_VALUES[data] * powers(base, len(data)))])


def hash_of(sums: np.ndarray, inverse: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sums[b] - sums[a]) * powers(inverse, len(sums))[a] + (b - a).astype(U64))


def sliding_argmin(key: np.ndarray, w: int) -> np.ndarray:
    """The place of the least of every w keys in a row, the first of equal ones. Keys are cut to 64 - POSITION_BITS bits."""
    most, n = 1 << POSITION_BITS, len(key)
    if n > most:
        step = most - w + 1
        return np.concatenate([sliding_argmin(key[a : a + most], w) + a for a in range(0, n - w + 1, step)])
    packed = (key & U64(((1 << 64) - 1) ^ (most - 1))) | np.arange(n, dtype=U64)
    rows = -(-n // w)
    full = np.full(rows * w, U64((1 << 64) - 1))
    full[:n] = packed
    ahead = np.minimum.accumulate(full.reshape(rows, w), 1).reshape(-1)
    behind = np.minimum.accumulate(full.reshape(rows, w)[:, ::-1], 1)[:, ::-1].reshape(-1)
    return (np.minimum(behind[: n - w + 1], ahead[w - 1 : n]) & U64(most - 1)).astype(np.int64)


class Seen:
    """Windows that a task has met twice, by two hashes: of these a task sends on one only, so no window has more rows than
    there are tasks, however many documents share it. The latest KEPT are remembered."""

    KEPT = 1 << 19

    def __init__(self):
        self.h1, self.h2 = np.empty(0, np.int64), np.empty(0, np.int64)

    def decide(self, h1: np.ndarray, h2: np.ndarray, twice: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(whether each window is known to be there twice, the numbers of those that tell other tasks so).

        twice: windows that are known to be, whatever this task has seen."""
        decided = np.zeros(len(h1), bool)
        if len(self.h1):
            k = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
            decided = (self.h1[k] == h1) & (self.h2[k] == h2)
        order = np.lexsort((h2, h1))
        change = np.concatenate([[True], (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])])[: len(order)]
        first = np.flatnonzero(change)
        count = np.diff(np.append(first, len(order)))
        many = count > 1
        if twice is not None and len(first):
            many |= np.maximum.reduceat(twice[order], first)
        told = order[first[many & ~decided[order[first]]]]
        decided[order] |= np.repeat(many, count)
        if len(told):
            h = np.concatenate([h1[told], self.h1])[: self.KEPT], np.concatenate([h2[told], self.h2])[: self.KEPT]
            order = np.argsort(h[0], kind="stable")
            self.h1, self.h2 = h[0][order], h[1][order]
        return decided, told


def joined(text: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of the runs of neighbouring windows."""
    if not len(text):
        return text, place, place
    order = np.lexsort((place, text))
    text, place = text[order], place[order]
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (place[1:] > place[:-1] + 1)])
    first = np.flatnonzero(new)
    return text[first], place[first], place[np.append(first[1:], len(text)) - 1] + length


def window_runs(sums: np.ndarray, base: np.ndarray, length: int, gram: int, sides: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of neighbouring windows with one anchor, on one side of it: (text, first window, windows, key, anchor).

    A window has `length` symbols; its anchor is the `gram` symbols in it of the least hash. sums: prefix sums of the symbols'
    values by powers of BASE; base: where each text begins, and the end. The key is of what the run's windows have in common;
    without `sides` of the anchor alone, and runs are on both sides of it.
    """
    empty = np.empty(0, np.int64)
    n = len(sums) - 1
    if n < length:
        return empty, empty, empty, empty, empty
    p = np.arange(n - gram + 1)
    anchor = sliding_argmin(hash_of(sums, INVERSE, p, p + gram), length - gram + 1)
    of = np.repeat(np.arange(len(base) - 1), np.diff(base))[: len(anchor)]
    p = np.flatnonzero(np.arange(len(anchor)) + length <= base[of + 1])
    if not len(p):
        return empty, empty, empty, empty, empty
    a, of = anchor[p], of[p]
    half = (length - gram) // 2
    side = (a - p <= half) | (not sides)
    begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (side[1:] != side[:-1]) | (of[1:] != of[:-1])]))
    number = np.diff(np.concatenate([begin, [len(p)]]))
    p, a, side, of = p[begin], a[begin], side[begin], of[begin]
    # What all windows of that side have in common: from the anchor on, or up to its end.
    low, high = np.where(side, a, a - half - 1), np.where(side & sides, a + length - half, a + gram)
    with np.errstate(over="ignore"):
        key = mix(hash_of(sums, INVERSE, low, high) + side.astype(U64)).view(np.int64)
    return of, p, number, key, a
