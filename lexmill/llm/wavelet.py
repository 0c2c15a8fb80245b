"""Range reporting over points of a permutation by a wavelet tree, for many rectangles at once.

The tree is held as one row of ranks a bit, from the highest: at each, the points
keep their order but those whose bit is 0 come first.  A rectangle is a range of
places and a range of values.  It goes down from the root as a range of places
in a node; a child is left out if no place of it is in the range, or none of its
values are asked for.  All rectangles go down a level together.
"""

from __future__ import annotations

import numpy as np


class WaveletTree:
    def __init__(self, values: np.ndarray) -> None:
        """values: the value at each place; each of 0 to n - 1 once."""
        self.bits = max(1, int(len(values) - 1).bit_length()) if len(values) else 0
        self.ranks: list[np.ndarray] = []
        held = np.asarray(values, np.int64)
        for bit in reversed(range(self.bits)):
            low = (held >> bit & 1) == 0
            self.ranks.append(np.concatenate(([0], np.cumsum(low))))
            held = np.concatenate((held[low], held[~low]))

    def report(self, first: np.ndarray, last: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rectangle and value of each point with place in [first, last) and value in [least, most)."""
        which = np.flatnonzero((first < last) & (least < most))
        low, high, base = first[which].astype(np.int64), last[which].astype(np.int64), np.zeros(len(which), np.int64)
        for level, ranks in enumerate(self.ranks):
            half = 1 << (self.bits - 1 - level)
            zeros, low_0, high_0 = ranks[-1], ranks[low], ranks[high]
            left = np.flatnonzero((low_0 < high_0) & (base < most[which]) & (base + half > least[which]))
            low_1, high_1, upper = zeros + low - low_0, zeros + high - high_0, base + half
            right = np.flatnonzero((low_1 < high_1) & (upper < most[which]) & (upper + half > least[which]))
            which = np.concatenate((which[left], which[right]))
            low, high = np.concatenate((low_0[left], low_1[right])), np.concatenate((high_0[left], high_1[right]))
            base = np.concatenate((base[left], upper[right]))
        return which, base
