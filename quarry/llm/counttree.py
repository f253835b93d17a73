"""R-tree over count vectors: which pairs of sets can overlap enough?

A set's elements are hashed into groups; its count vector is a point. The
overlap of two sets is at most the sum of the coordinate-wise minima of their
points, and the same sum over the upper corners of two boxes bounds every pair
of points in them. The tree is packed bottom-up; the join of the tree with
itself goes down level by level and drops box pairs whose bound is too small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 16
PAIRS_AT_ONCE = 1 << 14
#: Coordinates that boxes add up into one; points are compared in full after that.
FOLD = 8


def pack(counts: np.ndarray) -> bytes:
    """A count vector as a shift and one byte per coordinate, rounded up, so that bounds stay bounds."""
    shift = 0
    while (-(-counts >> shift)).max() > 255:
        shift += 1
    return bytes([shift]) + (-(-counts >> shift)).astype(np.uint8).tobytes()


def unpack(rows: list[bytes]) -> np.ndarray:
    wide = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1).astype(np.int32)
    return wide[:, 1:] << wide[:, :1]


def enough(overlap: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Jaccard similarity of 0.8 or more: 9 * overlap >= 4 * (sum of sizes)."""
    return 9 * overlap >= 4 * total


class CountTree:
    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # packed by size, then by the coordinate that varies most among neighbours in size
        coarse = points.reshape(len(points), -1, FOLD).sum(2)
        order = np.argsort(sizes, kind="stable")
        if len(order) > FAN:
            axis = int(coarse.var(0).argmax())
            tile = np.arange(len(order)) // (FAN * max(1, int((len(order) / FAN) ** 0.5)))
            order = order[np.lexsort((coarse[order, axis], tile))]
        self.order, self.points = order, points[order]
        self.levels = [(coarse[order], sizes[order])]
        while len(self.levels[-1][1]) > 1:
            high, small = self.levels[-1]
            starts = np.arange(0, len(small), FAN)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(small, starts)))

    def close_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, bound) for the pairs of points whose bound and sizes allow the similarity."""
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > PAIRS_AT_ONCE:
                for lo in range(0, len(i), PAIRS_AT_ONCE):
                    stack.append((level, i[lo:lo + PAIRS_AT_ONCE], j[lo:lo + PAIRS_AT_ONCE]))
                continue
            high, small = self.levels[level]
            bound = np.minimum(high[i], high[j]).sum(1)
            keep = enough(bound, small[i] + small[j])
            if level == 0:
                keep &= (i < j) & (5 * np.minimum(small[i], small[j]) >= 4 * np.maximum(small[i], small[j]))
                i, j = i[keep], j[keep]
                bound = np.minimum(self.points[i], self.points[j]).sum(1)
                keep = enough(bound, small[i] + small[j])
                if keep.any():
                    yield self.order[i[keep]], self.order[j[keep]], bound[keep]
                continue
            i, j = i[keep], j[keep]
            below = len(self.levels[level - 1][1])
            step = np.arange(FAN)
            # box by box, so that no more than a bounded number of children is laid out at once
            for lo in range(0, len(i), PAIRS_AT_ONCE // (FAN * FAN)):
                a = i[lo:lo + PAIRS_AT_ONCE // (FAN * FAN), None, None] * FAN + step[:, None]
                b = j[lo:lo + PAIRS_AT_ONCE // (FAN * FAN), None, None] * FAN + step
                a, b = (x.ravel() for x in np.broadcast_arrays(a, b))
                real = (a < below) & (b < below) & (a <= b)
                stack.append((level - 1, a[real], b[real]))


def small_run_pairs(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs within each of many short runs, some runs at a time."""
    for n in np.unique(lengths[lengths > 1]):
        own = starts[lengths == n]
        a, b = np.triu_indices(n, 1)
        for lo in range(0, len(own), max(1, PAIRS_AT_ONCE // len(a))):
            at = own[lo:lo + max(1, PAIRS_AT_ONCE // len(a)), None]
            yield (at + a).ravel(), (at + b).ravel()
