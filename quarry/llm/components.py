"""Distributed connected components: alternating large and small stars.

Every round is two aggregates and two joins on the current edges, written to
the shared folder, so a lost executor costs tasks and no round is repeated. The
number of rounds grows with the logarithm of a component's size, not with the
length of its chains. Before the first round each task replaces its edges by a
spanning forest of them; a group whose members are all linked shrinks to a tree
there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

#: Edges a task holds before it passes their forest on.
HELD_EDGES = 1 << 19


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and least node of its component, for each node but the least."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[:len(a)], where[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        lo, hi = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, hi, lo)
        while not (root[root] == root).all():
            root = root[root]
        open_ = root[x] != root[y]
        x, y = x[open_], y[open_]
    low = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[low], nodes[root[low]]


def _forest(batches: Iterator) -> Iterator:
    import pyarrow as pa

    a = b = np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy()])
        b = np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > HELD_EDGES:
            a, b = spanning_forest(a, b)
            if len(a) > HELD_EDGES // 2:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])
                a = b = a[:0]
    a, b = spanning_forest(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (least id reachable) of every node of ``edges`` (columns a, b: bigint) but those that are their component's least."""
    pairs = saved(edges.filter("a <> b").select("a", "b").mapInArrow(_forest, "u bigint, v bigint").distinct(), "cc")
    known = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == known or not state[0]:
            return pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
        known = state
        # large star: every larger neighbour goes to the least of the neighbourhood
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node whose neighbours are all smaller keeps its link to the least
        large = large.distinct()
        # small star: every smaller neighbour and the node itself go to the least smaller one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = saved(least.select("u", F.col("m").alias("v")).union(rest).distinct(), "cc")
