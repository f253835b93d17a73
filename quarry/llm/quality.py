"""Quality classifier by importance resampling (operator 3).

Two generative models over hashed n-grams, one of target texts (a bounded
sample of labelled good rows) and one of all raw texts, give every document the
log importance weight ``sum log p_target - log p_raw``. The grams are words,
word pairs and, because junk is mostly a matter of form, pairs and triples of
word shapes (runs of lower case, upper case, digits and each punctuation mark,
and whether a word repeats its predecessor). Gumbel noise drawn from the
document's own hash turns a top-k of weight + noise into sampling k documents
without replacement in proportion to their weights; k is the share of good
rows among the labelled, times all rows.

The models are two arrays of CELLS counts (fixed size). Raw counts cover all
texts. The k-th key is found exactly by refining histograms of its 64 bits, 16
at a time, so no rows are sorted or gathered in one task.

Defined results: null text is empty; an empty text has weight 0; a row is
selected if its key is at least the k-th key, so equal keys are selected
together (repeated rows share their noise); without labelled good rows all
weights are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import private, saved
from quarry.llm.textarrays import PIECE, groups_of, mix, pieces, powers, word_hashes

WORD_BITS, SHAPE_BITS = 17, 14
CELLS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Labelled rows that may be fitted (bound of the target model's sample).
SAMPLE = 20_000
SEED = 11

_CLASS = np.arange(256, dtype=np.uint64) + np.uint64(16)  # each mark is a class of its own
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS = mix(_CLASS)


def shapes(buf: bytes, starts: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: its character classes with runs written once."""
    b = np.frombuffer(buf, np.uint8)
    kind = _CLASS[b]
    space = np.isin(b, np.array([0x20, 9, 10, 11, 12, 13], np.uint8))
    # an accented capital of Latin-1 counts as upper case
    capital = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E))
    kind[capital] = kind[capital + 1] = _CLASS[65]
    new = np.ones(len(b), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    new &= ~space
    run = np.cumsum(new)
    run -= np.repeat(run[starts], np.diff(starts, append=len(b))) if starts[0] == 0 else np.concatenate(
        [run[:starts[0]], np.repeat(run[starts], np.diff(starts, append=len(b)))])
    with np.errstate(over="ignore"):
        value = np.where(new, kind * powers(int(run.max()) + 1)[np.maximum(run, 0)], np.uint64(0))[starts[0]:]
        return mix(np.add.reduceat(value, starts - starts[0]))


def cells(buf: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, text slot) of every n-gram of the texts that start at ``offs``; no n-gram spans two texts."""
    h, starts = word_hashes(buf)
    if not len(starts):
        return np.empty(0, np.int64), starts
    where = np.searchsorted(offs, starts, "right") - 1
    shape = shapes(buf, starts)
    one = where[1:] == where[:-1]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & one
    shape = np.where(same, mix(shape + np.uint64(1)), shape)
    with np.errstate(over="ignore"):
        pair = mix(h[1:] * np.uint64(3) + h[:-1])
        two = mix(shape[1:] * np.uint64(5) + shape[:-1])
        three = mix(two[1:] * np.uint64(7) + shape[:-2])
    w, s = np.uint64(64 - WORD_BITS), np.uint64(64 - SHAPE_BITS)
    base = np.uint64(1 << WORD_BITS)
    # a word that repeats its predecessor counts by shape only, else one junk text of a repeated word taints that word
    fresh, pairs, triples = ~same, one & ~same[1:], one[1:] & one[:-1]
    return (np.concatenate([h[fresh] >> w, pair[pairs] >> w, (two[one] >> s) + base, (three[triples] >> s) + base]).astype(np.int64),
            np.concatenate([where[fresh], where[1:][pairs], where[1:][one], where[2:][triples]]))


def count_cells(batches: Iterator) -> Iterator:
    """Counts of a task's texts: one row per cell in use."""
    import pyarrow as pa

    total = np.zeros(CELLS, np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in groups_of(texts):
            for buf, _, offs in pieces(texts[part]):
                total += np.bincount(cells(buf, offs)[0], minlength=CELLS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["cell", "n"])


def _model(docs: DataFrame) -> np.ndarray:
    got = docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary")).mapInArrow(count_cells, "cell bigint, n bigint").groupBy("cell").agg(
        F.sum("n").alias("n")).toArrow()  # at most CELLS rows
    total = np.zeros(CELLS)
    total[got["cell"].to_numpy()] = got["n"].to_numpy()
    return total


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target / p_raw of every cell; words and shapes are distributions of their own; both models add one to each cell."""
    out = np.zeros(CELLS)
    if target.sum() == 0:
        return out
    for part in (slice(0, 1 << WORD_BITS), slice(1 << WORD_BITS, CELLS)):
        t, r = target[part] + 1.0, raw[part] + 1.0
        out[part] = np.log(t / t.sum()) - np.log(r / r.sum())
    return out


def noise_hash(docs: DataFrame, seed: int = SEED):
    """64-bit hash of a document's id and text, the source of its noise."""
    return F.xxhash64(docs["doc_id"].cast("string"), F.coalesce(docs["text"], F.lit("")), F.lit(seed))


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, key (weight + Gumbel noise), the key's 64 bits in order as ``bits`` and the noise's hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.cast("binary"), noise_hash(docs, seed))

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            weight = np.zeros(len(texts))
            for part in groups_of(texts):
                for buf, docs_, offs in pieces(texts[part]):
                    cell, slot = cells(buf, offs)
                    weight[part] += np.bincount(docs_[slot], ratio[cell], minlength=part.stop - part.start)
            u = ((batch.column(2).to_numpy().view(np.uint64) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
            key = weight - np.log(-np.log(u))
            bits = key.view(np.int64)
            bits = np.where(bits < 0, ~bits ^ np.int64(-(1 << 63)), bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weight), pa.array(key), pa.array(bits), batch.column(2)], names=["doc_id", "log_weight", "key", "bits", "noise"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, log_weight double, key double, bits bigint, noise bigint")


def kth_largest(rows: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, exactly: four histograms of 16 bits each. None: all rows are wanted."""
    known, need = None, k
    for low in (48, 32, 16, 0):
        part = rows if known is None else rows.filter(F.shiftright(column, low + 16) == known)
        found = dict(part.groupBy(F.shiftright(column, low).alias("b")).count().collect())  # at most 65,536 rows
        for b in sorted(found, reverse=True):
            if found[b] >= need:
                known = b
                break
            need -= found[b]
        else:
            return None
    return known


def good_share(labels: DataFrame) -> float:
    n, good = labels.filter("quality is not null").agg(F.count("*"), F.count(F.when(F.col("quality") == 1, 1))).first()
    return good / n if n else 1.0


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, key, selected and noise for every document. ``k``: documents to sample; by default the good share of all."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    n = good.count()
    at = F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    chosen = good.filter(at < min(1.0, sample / max(n, 1))).limit(sample * 3 // 2)
    target = _model(docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("_id"), "left_semi"))
    ratio = log_ratio(target, _model(docs))
    rows = saved(weigh(docs, ratio, seed), "quality")
    if k is None:
        k = round(good_share(labels) * rows.count())
    limit = kth_largest(rows, "bits", k) if k > 0 else (1 << 63) - 1
    picked = F.lit(True) if limit is None else F.col("bits") >= F.lit(limit)
    return rows.select("doc_id", "log_weight", "key", picked.alias("selected"), "noise")


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` without those that the sampling rejects."""
    ident, theirs, own = private(docs, "_id", "_theirs", "_noise")
    out = resample(docs.select("doc_id", "text"), labels, seed=seed).filter("not selected").select(F.col("doc_id").alias(ident), F.col("noise").alias(theirs)).distinct()
    same = F.col(ident).eqNullSafe(F.col("doc_id")) & (F.col(theirs) == F.col(own))
    return docs.withColumn(own, noise_hash(docs, seed)).join(out, same, "left_anti").select(*docs.columns)
