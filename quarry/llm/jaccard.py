"""Near-duplicate documents: Jaccard join of word shingles with count-vector R-trees (operator 5).

Exact. A document's shingles are 64-bit hashes; documents with equal sets are
one set. Count vectors of hashed groups are indexed in R-trees (``counttree``).
One tree over a corpus would prune little near its root, since the boxes of
unrelated texts overlap in every group, so the index is cut along its rarest
axes first: each set is routed to those of its shingles that come first in the
order (documents in the shingle's frequency group, hash). Sets of n shingles
that reach the similarity must share one of their first n - ceil(0.8 n) + 1, so
no pair is lost, and shingles of widespread passages come last and route almost
nothing. The sets that meet at a shingle form a run.

Groups of copies are never expanded into pairs:
1. every set of a run is verified against the run's first set; the others of a run
   are cut where their sizes leave a gap that no pair can span;
2. runs that are not yet one component get an R-tree, and each set is verified
   against its PARTNERS closest sets by the bound on the overlap;
3. of runs where that left pairs out and that still hold several components, all
   pairs across components that the R-tree cannot exclude are verified.
Most sets share a shingle with others by chance only, so a pair's count vectors meet
first, and whole sets are read for pairs that the bound allows, once for each pair.
Verification compares whole sets, by KEPT_BYTES of each hash. Equal parts of
different hashes only add to an overlap, so what falls short is no pair, and a
surplus of ``doubt`` makes a pair; the few pairs between that are not yet in one
component are verified by whole hashes. Runs of more than BLOCK sets are dealt out
as pairs of blocks. Components come from star contraction, edges only from verified
pairs. Tables are deleted when no step reads them any more.

Defined results: null and empty texts and texts without words have 0 shingles
and are linked with nothing; with fewer than WORDS words the whole sequence is
the one shingle; repeated rows are linked; null ids never become a component's
id unless all its ids are null; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import private, saved, stored
from quarry.llm.components import connected_components
from quarry.llm.counttree import CountTree, enough, pack, small_run_pairs, unpack
from quarry.llm.textarrays import doc_words, groups_of, mix

WORDS = 5
GROUPS = 256  # coordinates of a count vector
FREQUENCY_BITS = 16  # groups whose document counts order the shingles
PARTNERS = 4
BLOCK = 2048
SMALL = 24  # runs up to this size are compared without a tree
BITMAP_BITS = 1 << 23
#: Bytes of a shingle's hash, and those kept when whole sets travel.
HASH_BYTES = 8
KEPT_BYTES = 5
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WORDS)], np.uint64)


def shingle_sets(texts: list) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for part in groups_of(texts):
        h, size = doc_words(texts[part])
        with np.errstate(over="ignore"):
            every = h[:0]
            if len(h) >= WORDS:
                every = mix(sum((h[WORDS - 1 - k:len(h) - k] * _POWERS[k] for k in range(1, WORDS)), h[WORDS - 1:].copy()))
            lo = 0
            for k in size:
                if k >= WORDS:
                    s = np.sort(every[lo:lo + k - WORDS + 1])
                    yield s[np.append(True, s[1:] != s[:-1])]
                elif k:
                    yield mix((h[lo:lo + k] * _POWERS[:k]).sum(dtype=np.uint64, keepdims=True) + np.uint64(k))
                else:
                    yield h[:0]
                lo += k


def set_id(s: np.ndarray) -> int:
    """64-bit hash of a set; equal sets have equal ids."""
    with np.errstate(over="ignore"):
        return int(mix(mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))).view(np.int64)[0])


def count_vector(s: np.ndarray) -> bytes:
    return pack(np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS))


def _frequency_group(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def read_documents(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, n, sid, vec) of documents, and rows (cell, docs) of the frequency groups; ``key`` is the text's md5, ``vec`` the count vector."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.md5(text).alias("key"), text.cast("binary"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, ids = np.zeros(1 << FREQUENCY_BITS, np.int64), None
        for batch in batches:
            ids = batch.column(0).type
            n, sid, vec, found = [], [], [], []
            for s in shingle_sets(batch.column(2).to_pylist()):
                n.append(len(s))
                sid.append(set_id(s) if len(s) else None)
                vec.append(count_vector(s) if len(s) else None)
                found.append(s)
                if len(found) >= 256:
                    total += np.bincount(_frequency_group(np.concatenate(found)), minlength=len(total))
                    found = []
            if found:
                total += np.bincount(_frequency_group(np.concatenate(found)), minlength=len(total))
            k = batch.num_rows
            none = pa.nulls(k, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(vec, pa.binary()), none, none], names=names)
        used = np.flatnonzero(total)
        if ids is not None and len(used):
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(used), ids), pa.nulls(len(used), pa.string()), none, none, pa.nulls(len(used), pa.binary()), pa.array(used), pa.array(total[used])], names=names)

    names = ["doc_id", "key", "n", "sid", "vec", "cell", "docs"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, key string, n bigint, sid bigint, vec binary, cell bigint, docs bigint")


def _new_sets(texts: Iterator) -> Iterator[tuple[int, np.ndarray]]:
    """Each set of the lists of texts once per task (again after a million others), with its id."""
    seen: set[int] = set()
    for some in texts:
        for s in shingle_sets(some):
            if len(s):
                sid = set_id(s)
                if sid not in seen:
                    seen.add(sid)
                    yield sid, s
                    if len(seen) > 1 << 20:
                        seen.clear()


def prefixes(docs: DataFrame, frequency: np.ndarray) -> DataFrame:
    """(key, sid, n): each set at its first shingles in the order."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keys, sids, sizes, held = [], [], [], 0

        def out():
            size = [len(k) for k in keys]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(sids, np.int64), size)),
                                               pa.array(np.repeat(np.array(sizes, np.int32), size))], names=["key", "sid", "n"])

        for sid, s in _new_sets(batch.column(0).to_pylist() for batch in batches):
            n = len(s)
            first = np.lexsort((s, frequency[_frequency_group(s)]))[:n - (4 * n + 4) // 5 + 1]
            keys.append(s[first])
            sids.append(sid)
            sizes.append(n)
            held += len(first)
            if held >= 1 << 18:
                yield out()
                keys, sids, sizes, held = [], [], [], 0
        if keys:
            yield out()

    return docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary")).mapInArrow(run, "key bigint, sid bigint, n int")


def _to_first(batches: Iterator) -> Iterator:
    """Sorted postings -> (key, sid, n, lo, n_lo) for every set of a run but its first, ``lo``."""
    import pyarrow as pa

    last = None  # key, sid, first sid and its size
    for batch in batches:
        if not batch.num_rows:
            continue
        k, s, n = (batch.column(i).to_numpy() for i in range(3))
        if last is not None:
            k, s, n = (np.concatenate([[x], y]) for x, y in zip((last[0], last[2], last[3]), (k, s, n), strict=True))
        starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        size = np.diff(starts, append=len(k))
        lo, n_lo = np.repeat(s[starts], size), np.repeat(n[starts], size)
        new = s != lo
        new[1:] &= (s[1:] != s[:-1]) | (k[1:] != k[:-1])
        if last is not None and len(s) > 1 and s[1] == last[1] and k[1] == k[0]:
            new[1] = False  # the last row of the batch before, again
        if new.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (k, s, n.astype(np.int32), lo, n_lo.astype(np.int32))], names=["key", "sid", "n", "lo", "n_lo"])
        last = k[-1], s[-1], lo[-1], n_lo[-1]


def compatible(a: Column, b: Column) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def allowed(pairs: DataFrame, vecs: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that the bound by count vectors does not exclude."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b, total = (batch.column(i).to_numpy() for i in range(3))
            near = np.zeros(len(a), bool)
            for lo in range(0, len(a), 1024):
                va, vb = (unpack(batch.column(i).slice(lo, 1024).to_pylist()) for i in (3, 4))
                near[lo:lo + 1024] = enough(np.minimum(va, vb).sum(1), total[lo:lo + 1024])
            yield pa.RecordBatch.from_arrays([pa.array(a[near]), pa.array(b[near])], names=["a", "b"])

    left, right = (vecs.select(F.col("sid").alias(p), F.col("n").alias(f"{p}_n"), F.col("vec").alias(f"{p}_vec")) for p in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("total"), "a_vec", "b_vec").mapInArrow(run, "a bigint, b bigint")


def whole_sets(docs: DataFrame, read: DataFrame, pairs: DataFrame, kept: int) -> DataFrame:
    """(sid, n, body) of the sets of ``pairs`` (a, b), ``kept`` bytes of each hash.

    One text of each set is looked for by its md5; a bitmap of fixed size keeps
    most other texts from being cut into shingles, the few it lets by are no harm.
    """
    sides = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    bit = F.conv(F.substring("key", 1, 12), 16, 10).cast("long") % BITMAP_BITS
    texts = read.select("sid", "key").join(sides, "sid", "left_semi").groupBy("sid").agg(F.min("key").alias("key"))
    cells = texts.select(bit.alias("bit")).groupBy(F.expr("bit div 64").cast("int").alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("v")).toArrow()  # at most BITMAP_BITS / 64 rows
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    bitmap[cells["cell"].to_numpy()] = cells["v"].to_numpy()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def wanted() -> Iterator[list]:
            for batch in batches:
                at = batch.column(1).to_numpy()
                yield batch.column(0).filter(pa.array((bitmap[at >> 6] >> (at & 63) & 1).astype(bool))).to_pylist()

        def out():
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

        rows, held = [], 0
        for sid, s in _new_sets(wanted()):
            rows.append((sid, len(s), s.view(np.uint8).reshape(-1, HASH_BYTES)[:, :kept].tobytes()))
            held += len(s)
            if held > 1 << 19:
                yield out()
                rows, held = [], 0
        if rows:
            yield out()

    import pyarrow as pa

    names = ["sid", "n", "body"]
    schema = pa.schema([("sid", pa.int64()), ("n", pa.int32()), ("body", pa.binary())])
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(text.cast("binary").alias("text"), F.md5(text).alias("key")).select("text", bit).mapInArrow(run, "sid bigint, n int, body binary")
    return found.dropDuplicates(["sid"])


def _body(x: bytes, kept: int) -> np.ndarray:
    wide = np.zeros((len(x) // kept, HASH_BYTES), np.uint8)
    wide[:, :kept] = np.frombuffer(x, np.uint8).reshape(-1, kept)
    return wide.view(np.uint64).ravel()


def doubt(total: int, kept: int) -> int:
    """So many matches by ``kept`` bytes may be of different hashes, for sets of ``total`` shingles together; more are as unlikely as equal whole hashes of different shingles."""
    if kept == HASH_BYTES:
        return 0
    some, whole = (2 * math.log(total) - (8 * k + 1) * math.log(2) for k in (kept, HASH_BYTES))
    k = 0  # the chance of more than k is at most some ** (k + 1) / (k + 1)!
    while (k + 1) * some - math.lgamma(k + 2) > whole:
        k += 1
    return k


def verify(pairs: DataFrame, sets: DataFrame, kept: int) -> DataFrame:
    """The pairs (a, b) of set ids whose sets reach the similarity; ``sure``: whatever the bytes left out are."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            total = na + nb
            near, sure = np.zeros(len(a), bool), np.zeros(len(a), bool)
            for i in range(len(a)):
                both = np.concatenate([_body(batch.column(c)[i].as_py(), kept) for c in (4, 5)])
                both.sort()
                equal = int((both[1:] == both[:-1]).sum())  # never fewer than the hashes in both
                near[i], sure[i] = enough(equal, total[i]), enough(equal - doubt(int(total[i]), kept), total[i])
            yield pa.RecordBatch.from_arrays([pa.array(a[near]), pa.array(b[near]), pa.array(sure[near])], names=["a", "b", "sure"])

    left, right = (sets.select(*[F.col(c).alias(f"{p}_{c}") for c in sets.columns]) for p in "ab")
    both = pairs.select("a", "b").join(left, F.col("a") == F.col("a_sid")).join(right, F.col("b") == F.col("b_sid"))
    return both.select("a", "b", "a_n", "b_n", "a_body", "b_body").mapInArrow(run, "a bigint, b bigint, sure boolean")


def linked(docs: DataFrame, read: DataFrame, pairs: DataFrame, kept: int) -> DataFrame:
    """``verify`` of ``pairs``, for which the texts are read again for their sets only; written."""
    sets = stored(whole_sets(docs, read, pairs, kept), "jac-sets")
    links = saved(verify(pairs, sets.rows, kept), "jac-links")
    sets.delete()
    return links


def confirm(docs: DataFrame, read: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the doubtful ``pairs`` whose sets reach the similarity by whole hashes."""
    return linked(docs, read, pairs, HASH_BYTES)


def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) across components."""
    a, b = (groups.select(F.col("id").alias(p), F.col("component").alias(f"{p}_c")) for p in "ab")
    named = pairs.select("a", "b").join(a, "a", "left").join(b, "b", "left")
    return named.filter(F.coalesce("a_c", "a") != F.coalesce("b_c", "b")).select("a", "b")


def size_runs(runs: DataFrame) -> DataFrame:
    """Members (key, sid) of the runs without their first sets, which have met all others, cut where no size is compatible with the next; sets left alone drop out."""
    order = Window.partitionBy("key").orderBy("n", "sid")

    def meets(other: Column) -> Column:
        return other.isNotNull() & compatible(other, F.col("n"))

    marked = runs.select("key", "sid", "n", meets(F.lag("n").over(order)).alias("before"), meets(F.lead("n").over(order)).alias("after"))
    part = F.sum(F.when(F.col("before"), 0).otherwise(1)).over(order)
    return marked.withColumn("part", part).filter("before or after").select(F.xxhash64("key", "part").alias("key"), "sid")


def open_runs(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members (key, sid) of the runs that hold several components, with ``comp`` and their run's ``size``."""
    named = members.join(groups.select(F.col("id").alias("sid"), "component"), "sid", "left").withColumn("comp", F.coalesce("component", "sid")).drop("component")
    split = named.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count("*").alias("size")).filter("c1 <> c2")
    return named.join(split.select("key", "size"), "key")


def tree_pairs(members: DataFrame, vecs: DataFrame, partners: int | None) -> DataFrame:
    """Distinct pairs (a, b) across components that the R-trees of the runs allow.

    With ``partners``: for each set its closest ones by the bound, within its
    block of a long run; rows (null, null, ``cut``) name the runs where pairs were
    left out. Without: all, over all pairs of blocks.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    if partners:
        dealt = members.select("key", "sid", "comp", own.alias("i"), own.alias("j"), F.lit(True).alias("left"))
    else:
        dealt = members.withColumns({"own": own, "o": F.explode(F.sequence(F.lit(0), blocks - 1))}).select(
            "key", "sid", "comp", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), (F.col("own") <= F.col("o")).alias("left"))
    rows = dealt.join(vecs.select("sid", "n", "vec"), "sid").select(
        F.xxhash64("key", "i", "j").alias("run"), "sid", "comp", "n", "vec", "left", (F.col("i") != F.col("j")).alias("cross"))
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "run").sortWithinPartitions("run", "sid")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def found(part):
            """All pairs of a table of whole runs, and the runs where pairs were left out."""
            key, sid, comp, n = (part[c].to_numpy() for c in ("run", "sid", "comp", "n"))
            vec = unpack(part["vec"].to_pylist())
            left, cross = part["left"].to_numpy(), part["cross"].to_numpy()
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(starts, append=len(key))
            out = []

            def keep(i, j, bound):
                good = (comp[i] != comp[j]) & (~cross[i] | (left[i] != left[j]))
                out.append((i[good], j[good], bound[good]))

            few = size <= SMALL
            for i, j in small_run_pairs(starts[few], size[few]):
                bound = np.minimum(vec[i], vec[j]).sum(1)
                near = enough(bound, n[i] + n[j]) & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))
                keep(i[near], j[near], bound[near])
            for lo, k in zip(starts[~few], size[~few], strict=True):
                for i, j, bound in CountTree(vec[lo:lo + k], n[lo:lo + k]).close_pairs():
                    keep(lo + i, lo + j, bound)
            cut = key[:0]
            if not out:
                return answer(np.empty((0, 2), np.int64), cut)
            i, j, bound = (np.concatenate(x) for x in zip(*out, strict=True))
            if partners and len(i):
                # of each set the pairs with the largest bound for their sizes
                share = bound / (n[i] + n[j])
                at, other, share = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([share, share])
                order = np.lexsort((other, -share, at))
                at, other = at[order], other[order]
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                rank = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
                near = rank < partners
                times = np.unique(np.stack([np.minimum(at, other), np.maximum(at, other)], 1)[near], axis=0)
                whole = np.bincount(np.searchsorted(starts, i, "right") - 1, minlength=len(starts))
                cut = key[starts][whole > np.bincount(np.searchsorted(starts, times[:, 0], "right") - 1, minlength=len(starts))]
                i, j = times[:, 0], times[:, 1]
            return answer(np.unique(np.stack([np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j])], 1), axis=0), cut)

        def answer(pairs, cut):
            a, b = (pa.array(np.append(pairs[:, k], cut), mask=np.arange(len(pairs) + len(cut)) >= len(pairs)) for k in (0, 1))
            return pa.RecordBatch.from_arrays([a, b, pa.array(np.append(pairs[:, 0], cut), mask=np.arange(len(pairs) + len(cut)) < len(pairs))], names=["a", "b", "cut"])

        held: list = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= 1 << 15:
                whole = pa.Table.from_batches(held)
                key = whole["run"].to_numpy()
                cut = len(key) - int((key == key[-1]).sum())  # the last run may go on
                if cut:
                    yield found(whole.slice(0, cut).combine_chunks())
                held = whole.slice(cut).to_batches()
                count = len(key) - cut
        if held:
            yield found(pa.Table.from_batches(held).combine_chunks())

    return rows.mapInArrow(run, "a bigint, b bigint, cut bigint").distinct()


def link_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(document rows: doc_id, key, n, sid; components: id, component over set ids)."""
    read = saved(read_documents(docs), "jac-docs")
    frequency = np.zeros(1 << FREQUENCY_BITS, np.int64)
    got = read.filter("cell is not null").groupBy("cell").agg(F.sum("docs").alias("docs")).toArrow()  # at most 65,536 rows
    frequency[got["cell"].to_numpy()] = got["docs"].to_numpy()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = prefixes(docs, frequency).repartition(parts, "key").sortWithinPartitions("key", "sid")
    runs = stored(sorted_.mapInArrow(_to_first, "key bigint, sid bigint, n int, lo bigint, n_lo int"), "jac-runs")
    sets = read.filter("sid is not null")
    vecs = stored(sets.select("sid", "n", "vec").dropDuplicates(["sid"]), "jac-vecs")

    first = runs.rows.filter(compatible(F.col("n"), F.col("n_lo"))).select(F.col("sid").alias("a"), F.col("lo").alias("b")).distinct()
    met = saved(allowed(first, vecs.rows).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jac-met")
    links = linked(docs, sets, met, KEPT_BYTES)
    groups = connected_components(links.filter("sure"))
    members = stored(size_runs(runs.rows), "jac-members")
    runs.delete()
    for partners in (PARTNERS, None):
        open_ = stored(open_runs(members.rows, groups), "jac-open")
        members.delete()
        found = stored(tree_pairs(open_.rows, vecs.rows, partners), "jac-found")
        pairs = saved(found.rows.filter("a is not null").select("a", "b").join(met, ["a", "b"], "left_anti"), "jac-met")
        links, met = links.union(linked(docs, sets, pairs, KEPT_BYTES)), met.union(pairs)
        groups = connected_components(links.filter("sure"))
        if partners:
            run = F.xxhash64("key", F.lit(0), F.lit(0))  # of a run of one block, as in tree_pairs
            cut = found.rows.filter("cut is not null").select("cut").distinct()
            again = open_.rows.filter(F.col("size") <= BLOCK).select("key", "sid", run.alias("cut")).join(cut, "cut", "left_semi")
            members = stored(again.select("key", "sid").union(open_.rows.filter(F.col("size") > BLOCK).select("key", "sid")), "jac-members")
        for table in (open_, found):
            table.delete()
    vecs.delete()
    doubtful = saved(apart(links.filter("not sure"), groups), "jac-doubtful")
    if not doubtful.isEmpty():
        groups = connected_components(links.filter("sure").union(confirm(docs, sets, doubtful)))
    return read.filter("cell is null").select("doc_id", "key", "n", "sid"), groups


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every document."""
    rows, groups = link_sets(docs)
    ids = rows.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    named = ids.join(groups.select(F.col("id").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").select("sid", "component_id")
    return rows.join(facts, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every group: the least (doc_id, md5 of the text). Documents without shingles all stay."""
    rows, groups = link_sets(docs)
    some = rows.filter("sid is not null").groupBy("sid").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    named = some.join(groups.select(F.col("id").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    first = named.groupBy("component").agg(F.min("first").alias("first")).select("first.*")
    # a document repeated with its id is one of a group, too
    times = rows.filter("sid is not null").groupBy("doc_id", "key").count().filter("count > 1").select(F.col("doc_id").alias("_i"), F.col("key").alias("_k"))
    empty = rows.filter("sid is null").select("doc_id", "key").distinct()
    ident, key, repeated, own = private(docs, "_id", "_key", "_repeated", "_text_key")
    stay = saved(first.join(times, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k")), "left").select(
        F.col("doc_id").alias(ident), F.col("key").alias(key), F.col("_k").isNotNull().alias(repeated)).union(
        empty.select("doc_id", "key", F.lit(False))), "jac-stay")
    keyed = docs.withColumn(own, F.md5(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(ident)) & (F.col(own) == F.col(key))
    once = keyed.join(stay.filter(~F.col(repeated)), same, "left_semi").select(*docs.columns)
    again = keyed.join(stay.filter(F.col(repeated)), same, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)
    return once.unionByName(again)
