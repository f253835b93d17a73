"""Hard-negative mining by slot-decomposed selection (operator 13).

Anchors (rows whose id is divisible by ``every``) are the stated query set and
meet all rows in blocks: rows are packed ``BLOCK`` to a record, anchors
``CHUNK`` to a record, every anchor record goes once to each group of row
records and a task multiplies two blocks at a time.

Two passes. The first keeps each anchor's best ``positives`` other rows of its
label. A positive of score s asks for rows of other labels with scores in
[0.3 s, 0.9 s]. The upper limits of an anchor's positives, in falling order,
cut the scores into disjoint slots; the second pass keeps the best ``negatives``
rows of each slot only (combined in the tasks, then over the tasks). As slots
fall, the window of the j-th positive is the merge of the slots from j on, cut
at its lower limit, and its first ``negatives`` entries are among those kept:
all overlapping windows are answered from one list of at most 50 rows an anchor.

A task holds one pair of blocks and the kept entries of at most ``HELD`` anchor
records; no label, vector or window is a shuffle key, so hot labels, copies and
ties cost nothing.

Defined results: rows with a null label or vector, or a null or non-finite
component, take no part. A row without an id is no anchor, may be a positive or
a negative, and comes last among equal scores. Rows that repeat an id are rows
of their own (an anchor row given twice is answered twice, and is its own
twin's positive). Vectors of different lengths are compared as if the shorter
ended in zeros; an empty vector scores 0. Products are exact; beyond the range
of a long they stay at its ends. A positive score below 0 has an empty window.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

EVERY = 100
POSITIVES = 5
NEGATIVES = 10
BLOCK = 2048
CHUNK = 512
HELD = 64
BLOCKS_A_GROUP = 32
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def prepare(vectors: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label (shifted where the id is divisible by 7) and embedding of the rows that take part."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    kept = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & usable)
    return saved(kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), shifted.cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("embedding")), "negative-rows")


def quantise(column) -> np.ndarray:
    """floor(256 x) of a list column as one matrix, short vectors filled up with zeros; 16-bit where that holds them."""
    size = np.diff(column.offsets.to_numpy())
    wide = int(size.max(initial=0))
    flat = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(size), wide))
    out[np.arange(wide) < size[:, None]] = np.nan_to_num(flat, posinf=np.finfo(float).max, neginf=-np.finfo(float).max)
    return out.astype(np.int16) if np.abs(out).max(initial=0) < 1 << 15 else out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` and ``b`` as 64-bit integers."""
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim].astype(float), b[:, :dim].astype(float)
    if dim * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    return np.array([[min(max(sum(x * y for x, y in zip(p, q)), _LEAST), _MOST) for q in whole[1]] for p in whole[0]], np.int64).reshape(len(a), len(b))


class Best:
    """The first ``k`` entries of every key by falling score, then named before unnamed, then smaller id."""

    def __init__(self, keys: int, k: int):
        self.k = k
        none = np.empty(0, np.int64)
        self.rows = (none, none, none, none)  # key, score, unnamed, id
        self.last = (np.full(keys, _LEAST), np.ones(keys, np.int64), np.full(keys, _MOST))
        self.full = np.zeros(keys, bool)

    def add(self, key: np.ndarray, score: np.ndarray, unnamed: np.ndarray, ident: np.ndarray) -> None:
        s, u, i = (x[key] for x in self.last)
        better = ~self.full[key] | (score > s) | ((score == s) & ((unnamed < u) | ((unnamed == u) & (ident < i))))
        if not better.any():
            return
        key, score, unnamed, ident = (np.concatenate([old, new[better]]) for old, new in zip(self.rows, (key, score, unnamed, ident)))
        order = np.lexsort((ident, unnamed, ~score, key))  # ~score: falling without overflow
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank = np.arange(len(key)) - np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        keep = rank < self.k
        self.rows = (key[keep], *(x[order][keep] for x in (score, unnamed, ident)))
        end = rank[keep] == self.k - 1
        at = self.rows[0][end]
        self.full[at] = True
        for limit, x in zip(self.last, self.rows[1:]):
            limit[at] = x[end]


def limits(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score of the window of each positive score: 30 s <= 100 n <= 90 s without overflow."""
    tens, rest = np.floor_divide(scores, 10), np.mod(scores, 10)
    return 3 * tens + -(-3 * rest // 10), 9 * tens + 9 * rest // 10


def _pack(batches: Iterator, most: int, with_scores: bool) -> Iterator:
    """Records of at most ``most`` rows: row numbers, ids, labels, quantised vectors and, for anchors, positive scores."""
    import pyarrow as pa

    for whole in batches:
        for lo in range(0, whole.num_rows, most):
            batch = whole.slice(lo, most)
            vectors = quantise(batch.column(3))
            ids = batch.column(1)
            body = [batch.column(0).to_numpy().tobytes(), ids.fill_null(_MOST).to_numpy().tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    batch.column(2).to_numpy().tobytes(), vectors.tobytes()]
            scores = np.full((batch.num_rows, POSITIVES), _LEAST)
            if with_scores:
                got = batch.column(4)
                size = np.diff(got.offsets.to_numpy())
                scores[np.arange(POSITIVES) < size[:, None]] = got.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*body, vectors.shape[1], scores.tobytes())], names=["rows", "ids", "unnamed", "labels", "vectors", "dim", "scores"])


_RECORD = "rows binary, ids binary, unnamed binary, labels binary, vectors binary, dim long, scores binary"


def packed(rows: DataFrame, most: int, with_scores: bool = False) -> DataFrame:
    return rows.mapInArrow(lambda batches: _pack(batches, most, with_scores), _RECORD)


def _unpack(batch, i: int, at: int):
    rows, ids, unnamed, labels, vectors, dim, scores = (batch.column(at + c)[i].as_py() for c in range(7))
    rows = np.frombuffer(rows, np.int64)
    wide = np.float64 if len(vectors) == 8 * dim * len(rows) and dim else np.int16
    return (rows, np.frombuffer(ids, np.int64), np.frombuffer(unnamed, np.int8).astype(np.int64), np.frombuffer(labels, np.int64),
            np.frombuffer(vectors, wide).reshape(len(rows), dim), np.frombuffer(scores, np.int64).reshape(len(rows), POSITIVES))


def meet(rows: DataFrame, anchors: DataFrame, keep, slots: int, k: int, groups: int) -> DataFrame:
    """Every anchor record against every row record; the best ``k`` entries an anchor and slot, combined in each task.

    ``keep(anchors, rows, products)`` names the entries that count: (anchor
    number, slot, row number) within the two blocks.
    """
    spread = packed(rows, BLOCK).withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    copies = anchors.withColumn("chunk", F.monotonically_increasing_id()).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = [c.split()[0] for c in _RECORD.split(", ")]
    copies = copies.select("g", "chunk", *[F.col(c).alias(f"a_{c}") for c in names])
    pairs = spread.repartition(groups, "g").join(copies.repartition(groups, "g").hint("merge"), "g").select("chunk", *[f"a_{c}" for c in names], *names)

    def combine(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[int, tuple[np.ndarray, Best]] = {}

        def out():
            for numbers, best in held.values():
                key, score, unnamed, ident = best.rows
                yield pa.RecordBatch.from_arrays([pa.array(numbers[key // slots]), pa.array((key % slots).astype(np.int32)), pa.array(score),
                                                  pa.array(ident, mask=unnamed.astype(bool))], names=["row", "slot", "score", "vec_id"])
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                chunk = batch.column(0)[i].as_py()
                a, r = _unpack(batch, i, 1), _unpack(batch, i, 8)
                if chunk not in held:
                    if len(held) >= HELD:
                        yield from out()
                    held[chunk] = a[0], Best(len(a[0]) * slots, k)
                s = products(a[4], r[4])
                who, slot, what = keep(a, r, s)
                held[chunk][1].add(who * slots + slot, s[who, what], r[2][what], r[1][what])
        yield from out()

    found = pairs.mapInArrow(combine, "row long, slot int, score long, vec_id long")
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _same_label(a, r, s):
    who, what = np.nonzero((a[3][:, None] == r[3]) & (a[0][:, None] != r[0]))
    return who, np.zeros(len(who), np.int64), what


def _in_slots(a, r, s):
    least, most = limits(a[5])
    least, most = np.where(a[5] < 0, _MOST, least), np.where(a[5] < 0, _LEAST, most)
    who, what = np.nonzero((a[3][:, None] != r[3]) & (s <= most.max(axis=1)[:, None]) & (s >= least.min(axis=1)[:, None]))
    return who, (s[who, what][:, None] <= most[who]).sum(axis=1) - 1, what


def hard_negatives(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every anchor, positive and negative found."""
    rows = prepare(vectors)
    n = rows.count()
    spark = rows.sparkSession
    groups = max(3 * spark.sparkContext.defaultParallelism, -(-n // (BLOCK * BLOCKS_A_GROUP)))
    queries = rows.filter(F.col("vec_id") % every == 0)
    chunks = -(-n // (every * CHUNK)) + 1
    plain = saved(packed(queries.repartition(chunks, "row"), CHUNK), "negative-anchors")
    best = meet(rows, plain, _same_label, 1, POSITIVES, groups)
    ranked = F.array_sort(F.collect_list(F.struct("place", "score", "vec_id")))
    positives = saved(best.groupBy("row").agg(ranked.alias("positives")), "negative-positives")  # at most POSITIVES entries
    asked = queries.join(positives, "row").select("row", "vec_id", "label", "embedding", F.col("positives.score").alias("scores"))
    slotted = saved(packed(asked.repartition(chunks, "row"), CHUNK, True), "negative-slots")
    kept = meet(rows, slotted, _in_slots, POSITIVES, NEGATIVES, groups)
    lists = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("slot", "place", "score", "vec_id"))).alias("kept"))  # falling scores; at most POSITIVES * NEGATIVES
    windows = queries.select("row", F.col("vec_id").alias("anchor_id")).join(positives, "row").join(lists, "row").select("anchor_id", "kept", F.posexplode("positives").alias("j", "positive"))
    inside = F.filter("kept", lambda e: (e["slot"] >= F.col("j")) & (e["score"] >= F.expr("3 * ((positive.score - pmod(positive.score, 10L)) div 10) + (3 * pmod(positive.score, 10L) + 9) div 10")))
    return windows.select("anchor_id", "positive", F.posexplode(F.slice(inside, 1, NEGATIVES)).alias("at", "negative")).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("negative.vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("negative.score").alias("negative_score"))
