"""Near-duplicates among embeddings by random hyperplanes (operator 2).

Equal vectors of a label are one vector with a count. The signs of its
products with seeded random hyperplanes give every vector a signature of
``bits`` bits in each of ``tables`` tables; vectors of one label and signature
meet in a bucket, where the exact cosine of all pairs is taken by matrix
products in double precision. A pair counts in the first table in which it
meets, so no list of pairs is kept: a task adds up each vector's links and
passes on a spanning forest of them. Buckets of more than BLOCK vectors are
dealt out as pairs of blocks, each a group of its own: exact, and no group is
larger than two blocks. Links become components by star contraction.

bits grow with the logarithm of the number of vectors, so buckets keep their
size, and tables follow from the wanted recall at the threshold.

Defined results: a vector that is null, empty, zero or has null or non-finite
parts, or whose label or id is null, has 0 links and is its own component;
vectors of different length are never linked; repeated rows link with each
other, and rows that share an id but not the vector or label are vectors of
their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.llm.components import connected_components, spanning_forest

THRESHOLD = 0.93
RECALL = 0.999
BUCKET = 256  # vectors a signature stands for, all labels together
BLOCK = 1024
SEED = 17


def shape_of(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors: one plane separates a pair at the threshold with probability angle / pi."""
    bits = min(60, max(6, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 6))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def planes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, bits * tables))


def signatures(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    sign = (x @ planes(x.shape[1], bits, tables) >= 0).reshape(len(x), tables, bits)
    return sign @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def links(x: np.ndarray, sig: np.ndarray, table: int, weight: np.ndarray, split: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(linked weight of each vector, and the linked pairs) in one group.

    ``split``: 0 compares all pairs, otherwise the first ``split`` vectors with the rest.
    """
    norm = np.sqrt((x * x).sum(1))
    a, b = (slice(None), slice(None)) if not split else (slice(0, split), slice(split, None))
    near = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :]) >= threshold
    if not split:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    j += split
    if table and len(i):
        first = ~(sig[i, :table] == sig[j, :table]).any(1)
        i, j = i[first], j[first]
    return np.bincount(i, weight[j], len(x)) + np.bincount(j, weight[i], len(x)), i, j


def _groups(batches: Iterator) -> Iterator:
    """Consecutive rows with the same key, across batches."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_pylist()
        lo = 0
        for i in range(1, len(key) + 1):
            if i == len(key) or key[i] != key[lo]:
                if held and held[0].column(0)[0].as_py() != key[lo]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, i - lo))
                if i < len(key):
                    yield pa.Table.from_batches(held)
                    held = []
                lo = i
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector."""
    whole = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    finite = F.forall("embedding", lambda e: F.coalesce((e > F.lit(-math.inf)) & (e < F.lit(math.inf)) & ~F.isnan(e), F.lit(False)))
    nonzero = F.exists("embedding", lambda e: e != 0)
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("ok", F.coalesce(whole & finite & nonzero, F.lit(False)))
    keyed = rows.withColumns({"k1": F.xxhash64("embedding", F.lit(1)), "k2": F.xxhash64("embedding", F.lit(2))})
    distinct = keyed.filter("ok").groupBy("label", "k1", "k2").agg(
        F.min("vec_id").cast("bigint").alias("least"), F.count("*").alias("copies"), F.first("embedding").alias("vec"))
    # an id may stand with several vectors or labels: a vector goes by a number of its own
    distinct = saved(distinct.select("label", "k1", "k2", F.monotonically_increasing_id().alias("rep"), "copies", "vec", "least"), "emb")
    n = distinct.count()
    bits, tables = shape_of(n, threshold, recall)

    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            vec = batch.column(5)
            size = np.diff(vec.offsets.to_numpy())
            flat, starts = vec.flatten().to_numpy(), np.cumsum(size) - size
            sig = np.zeros((len(size), tables), np.int64)
            for dim in np.unique(size):
                own = np.flatnonzero(size == dim)
                sig[own] = signatures(flat[starts[own][:, None] + np.arange(dim)], bits, tables)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, tables, dtype=np.int32)), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "sig"])

    label = vectors.schema["label"].dataType.simpleString()
    signed = saved(distinct.drop("least").mapInArrow(sign, f"label {label}, k1 bigint, k2 bigint, rep bigint, copies bigint, vec array<double>, sig array<bigint>"), "emb-signed")
    met = signed.select("rep", "label", F.size("vec").alias("dim"), F.posexplode("sig").alias("table", "s"))
    bucket = ["label", "dim", "table", "s"]
    sizes = met.groupBy(*bucket).count().filter("count > 1").withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    met = met.join(sizes.drop("count"), bucket)
    # block pairs (i, j) with i <= j; a vector of block m is in (m, j) for j >= m and (i, m) for i < m
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    met = met.withColumn("own", own).select("rep", "table", "own", *[c for c in bucket if c != "table"], F.explode(pair).alias("p"))
    met = met.select("rep", "table", (F.col("p.i") != F.col("p.j")).alias("cross"), (F.col("own") == F.col("p.i")).alias("left"),
                     F.xxhash64(*bucket, F.col("p.i"), F.col("p.j")).alias("key"))
    met = met.join(signed.select("rep", "copies", "vec", "sig"), "rep")
    met = met.select("key", "table", "cross", "left", "rep", "copies", "vec", "sig")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(parts, "key").sortWithinPartitions("key", "table", "cross")

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for group in _groups(batches):
            left = group["left"].to_numpy()
            order = np.argsort(~left, kind="stable")
            cross = group["cross"][0].as_py()
            if len(order) < 2 or cross and (left.all() or not left.any()):
                continue
            rep, weight = group["rep"].to_numpy()[order], group["copies"].to_numpy()[order].astype(float)
            x, sig = _matrix(group["vec"])[order], _matrix(group["sig"])[order]
            total, i, j = links(x, sig, group["table"][0].as_py(), weight, int(left.sum()) if cross else 0, threshold)
            if len(i):
                linked = np.flatnonzero(total)
                u, v = spanning_forest(rep[i], rep[j])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([rep[linked], u])), pa.array(np.concatenate([total[linked].astype(np.int64), v])),
                    pa.array(np.repeat([False, True], [len(linked), len(u)]))], names=["a", "b", "edge"])

    found = saved(met.mapInArrow(compare, "a bigint, b bigint, edge boolean"), "emb-links")
    group = connected_components(found.filter("edge").select("a", "b"))
    count = found.filter("not edge").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("linked"))
    named = distinct.select("rep", "least").join(group.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = named.join(named.groupBy("component").agg(F.min("least").alias("first")), "component").select("rep", "first")
    facts = distinct.select("label", "k1", "k2", "rep", "copies").join(count, "rep", "left").join(named, "rep")
    facts = facts.select(F.col("label").alias("_l"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"),
                         (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.col("first").alias("component"))
    out = keyed.select("vec_id", "label", "k1", "k2", "ok").join(
        facts, F.col("ok") & (F.col("label") == F.col("_l")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    component = F.coalesce("component", F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.cast("long").alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
