"""Trees grown whole inside one task, for rows that fit there.

A level of ``trees`` is a few jobs, whatever the data; hundreds of rounds or deep
trees of a table of thousands of rows are all planning then. Here a task has all
rows of its trees as arrays (a byte per feature) and grows them level by level
without leaving: all nodes of a level at once, by sums over (node, bin). The rules
are those of ``trees``: the same bins, draws of rows and features (Spark's xxhash64,
repeated here), splits, ties and leaves, so that both give the same trees (tested).

Who calls this decides by ``fits`` whether the rows fit; larger ones go level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, factorial, gcd

import numpy as np

POISSON = [sum(exp(-1) / factorial(i) for i in range(k + 1)) for k in range(9)]
LEAST_SHARE = 1e-9  # of a node's variance, and of its squares
#: Bytes of arrays that a task may hold for its rows.
TASK_BYTES = 1 << 28
#: Groups that are worth a call each.
MOST_GROUPS = 10_000
_P1, _P2, _P3, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def fits(rows: int, features: int, outputs: int) -> bool:
    """Whether a task can hold so many rows with what growing a tree of them takes."""
    return rows * (3 * features + 40 * outputs + 100) <= TASK_BYTES


def hash_int(value, seed):
    """Spark's xxhash64 of int ``value`` after what hashed to ``seed``, both arrays or numbers; int64."""
    with np.errstate(over="ignore"):
        h = np.asarray(seed, np.int64).view(np.uint64) + _P5 + np.uint64(4)
        h = h ^ ((np.asarray(value, np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF)) * _P1)
        h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * _P2 + _P3
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def unit(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number from 0 to 1 for every row and this tree; ``keys``: xxhash64 of the rows' keys."""
    return (hash_int(seed, hash_int(tree, keys)) & np.int64((1 << 40) - 1)) / float(1 << 40)


def bag(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the tree draws each row: Poisson(1)."""
    return np.searchsorted(POISSON, unit(keys, tree, seed), side="right")


def tried(nodes: np.ndarray, tree: int, features: int, columns: int | None, seed: int) -> np.ndarray:
    """(node, place) -> feature: those tried at each node."""
    if not columns or columns >= features:
        return np.tile(np.arange(features), (len(nodes), 1))
    steps = np.array([s for s in range(1, features) if gcd(s, features) == 1])
    draw = hash_int(seed + 1, hash_int(nodes, hash_int(tree, 42)))
    start = (draw.view(np.uint64) >> np.uint64(20)).astype(np.int64) % features
    return (start[:, None] + np.arange(columns) * steps[draw % len(steps)][:, None]) % features


class Outputs:
    """Weights and outputs of a tree's rows: numbers as ``y`` (row, output), or with ``means`` the indicators of the classes ``y``, less these."""

    def __init__(self, w, y, means=None):
        self.w, self.means = w, means
        if means is None:
            self.y, self.square = np.ascontiguousarray((w[:, None] * y).T), w * np.square(y).sum(1)
        else:
            self.y, self.square = y, w * (1 - 2 * means + np.square(means).sum())[y]

    def taken(self, rows) -> Outputs:
        out = object.__new__(Outputs)
        out.w, out.y, out.square, out.means = self.w[rows], self.y[..., rows], self.square[rows], self.means
        return out

    def sums(self, cell, cells: int, order=None):
        """Weights, and outputs as (output, cell), added up by ``cell``, that of the rows in ``order``."""
        w = self.w if order is None else self.w[order]
        if self.means is None:
            return np.bincount(cell, w, cells), np.stack([np.bincount(cell, v if order is None else v[order], cells) for v in self.y])
        many = len(self.means)
        by_class = np.bincount(cell + cells * (self.y if order is None else self.y[order]), w, cells * many).reshape(many, cells)
        n = by_class.sum(0)
        by_class -= self.means[:, None] * n
        return n, by_class


def _shares(left, n_left, s, n, total, spread, least: int, ridge: float):
    """The share of its node's variance that a cut takes away, -1 where it may not be made. ``left``: (output, ...) sums."""
    n_right = n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.square(left).sum(0) / (n_left + ridge) + np.square(s - left).sum(0) / (n_right + ridge)
        share = np.round((parts - total) / spread, 9)
    return np.where((n_left >= least) & (n_right >= least) & ~np.isnan(share), share, -1.0)


def best_splits(rank, count: int, bins, outputs: Outputs, slots, least: int = 1, ridge: float = 0.0):
    """The best split of each of ``count`` nodes: (nodes that are split, feature, bin, left values, right values).

    ``rank``: node of a row; ``slots``: (node, place) -> feature tried."""
    q = np.bincount(rank, outputs.square, count)
    n, s = outputs.sums(rank, count)
    total = np.square(s).sum(0) / (n + ridge)
    spread = q - total
    mixed = spread > LEAST_SHARE * q  # else all outputs are equal but for rounding
    if not mixed.all():
        keep = np.flatnonzero(mixed[rank])
        rank, bins, outputs = rank[keep], bins[keep], outputs.taken(keep)
    share, place = np.zeros(count), np.full(count, 1 << 30)
    low, n_low = np.zeros_like(s), np.zeros(count)
    if not len(rank):
        return np.zeros(0, np.int64), place[:0], place[:0], low[:, :0].T, low[:, :0].T
    rows, features, width = np.arange(len(rank)), bins.shape[1], int(bins.max()) + 1
    flat, dense, all_ = bins.ravel(), count * width <= len(rank), np.arange(count)
    small = count <= 1 << 16
    for j in range(slots.shape[1]):
        feature = slots[:, j]
        at = flat[rows * features + feature[rank]]
        if dense:
            here, sums = outputs.sums(rank * width + at, count * width)
            here, sums = here.reshape(count, width), sums.reshape(-1, count, width).cumsum(2)
            n_left = here.cumsum(1)
            got = _shares(sums, n_left, s[:, :, None], n[:, None], total[:, None], spread[:, None], least, ridge)
            got[here == 0] = -1.0
            bin_ = got.argmax(1)
            found, node, left, n_left = got[all_, bin_], all_, sums[:, all_, bin_], n_left[all_, bin_]
        else:
            order = np.argsort(at, kind="stable")
            order = order[np.argsort(rank[order].astype(np.uint16) if small else rank[order], kind="stable")]
            r, b = rank[order], at[order]
            starts = np.append(True, (r[1:] != r[:-1]) | (b[1:] != b[:-1]))
            here, sums = outputs.sums(np.cumsum(starts) - 1, int(starts.sum()), order)
            r, b = r[starts], b[starts]
            first = np.searchsorted(r, all_[: r[-1] + 1])  # a node's cells
            upto = lambda v: (run := np.append(0.0, v.cumsum()))[1:] - run[first][r]
            sums, n_left = np.stack([upto(v) for v in sums]), upto(here)
            got = _shares(sums, n_left, s[:, r], n[r], total[r], spread[r], least, ridge)
            seen = np.unique(r)
            top = np.zeros(count)
            top[seen] = np.maximum.reduceat(got, first[seen])
            best = np.flatnonzero(got == top[r])
            best = best[np.append(True, r[best][1:] != r[best][:-1])]
            node, bin_, found, left, n_left = r[best], b[best], got[best], sums[:, best], n_left[best]
        here = (feature[node].astype(np.int64) << 8) | bin_
        better = (found > share[node]) | ((found == share[node]) & (here < place[node]))
        node = node[better]
        share[node], place[node], low[:, node], n_low[node] = found[better], here[better], left[:, better], n_left[better]
    at = np.flatnonzero(mixed & (share > LEAST_SHARE))
    low, n_low = low[:, at], n_low[at]
    return at, place[at] >> 8, place[at] & 255, (low / (n_low + ridge)).T, ((s[:, at] - low) / (n[at] - n_low + ridge)).T


def grown(bins, outputs: Outputs, others, tree: int, depth: int, columns: int | None = None, seed: int = 42, least: int = 1, ridge: float = 0.0,
          keep: list | None = None) -> Iterator[np.ndarray]:
    """Grows one tree of the rows ``bins`` with their ``outputs``; yields what it says of the rows ``others`` at depth 0, 1, ... ``depth`` (the same array, changed from depth to depth). ``keep`` gets the splits of
    each level: node, feature, bin, left and right values."""
    rank, nodes, place = np.zeros(len(bins), np.int64), np.ones(1, np.int64), np.zeros(len(others), np.int64)
    n, s = outputs.sums(rank, 1)
    value = np.tile(s[:, 0] / (n + ridge), (len(others), 1))
    yield value
    for _ in range(depth):
        if len(nodes):
            at, feature, cut, left, right = best_splits(rank, len(nodes), bins, outputs, tried(nodes, tree, bins.shape[1], columns, seed), least, ridge)
            if keep is not None:
                keep.append((nodes[at], feature, cut, left, right))
            below = np.full(len(nodes), -1)
            below[at] = np.arange(len(at))
            new = below[rank]
            stay = np.flatnonzero(new >= 0)
            new, bins, outputs = new[stay], bins[stay], outputs.taken(stay)
            rank = 2 * new + (bins[np.arange(len(new)), feature[new]] > cut[new])
            live = np.flatnonzero(place >= 0)
            new = below[place[live]]
            place[live[new < 0]] = -1
            live, new = live[new >= 0], new[new >= 0]
            side = others[live, feature[new]] > cut[new]
            place[live] = 2 * new + side
            value[live] = np.where(side[:, None], right[new], left[new])
            nodes = np.stack([2 * nodes[at], 2 * nodes[at] + 1], 1).ravel()
        yield value


def boosted(bins, keys, y, rounds: int, depth: int, rate: float, ridge: float, least: int, sample: float, columns: int | None, seed: int,
            others=None, keep: list | None = None) -> Iterator[np.ndarray]:
    """Boosted trees of the rows ``bins`` with centred labels ``y``; yields after each round what the trees so far say of the rows
    ``others``. ``keep`` gets each round's (root value, splits of its levels)."""
    none = bins[:0] if others is None else others
    walked, left, said = np.concatenate([bins, none]), np.array(y, np.float64), np.zeros(len(none))
    for t in range(rounds):
        drawn = np.flatnonzero(unit(keys, t, seed) < sample) if sample < 1 else np.arange(len(y))
        if len(drawn):
            splits: list = []
            for level, value in enumerate(grown(bins[drawn], Outputs(np.ones(len(drawn)), left[drawn, None]), walked, t, depth, columns, seed, least, ridge, splits)):
                if not level and keep is not None:
                    keep.append((t, value[0, 0], splits))
            left -= rate * value[: len(y), 0]
            said += rate * value[len(y):, 0]
        yield said


def matrix(column, width: int) -> np.ndarray:
    """An Arrow column of lists of ``width`` numbers as (row, place)."""
    whole = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
