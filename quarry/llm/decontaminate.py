"""Benchmark decontamination by a broadcast hash set of test n-grams (operator 10, native).

A window is ``n`` consecutive words of an item (all its words, if it has
fewer). The windows' 64-bit hashes fill a bitmap sized from their number,
which travels as a constant: a document's windows are hashed and tested inside the row, with
no shuffle, and only the few that pass are written out as rows. These are then
verified by their text against the window table, which is broadcast when it
was counted and is small, and shuffled otherwise. Item ids are kept once per
window, so a document that repeats a window thousands of times makes one row
per occurrence and nothing per item.

Defined results: null text has no words; an item with no words has no window;
an item with a null id marks words but is not counted or listed; a repeated
document is reported once per row; empty tables give no hits. Documents are
told apart by row, not by id, so repeated or null ids do not meet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, private, saved

N = 10
SPLIT = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Bits of the prefilter: at least these, else BITS_PER_WINDOW for each window (so that fewer than 1 % of other
#: windows pass), at most MOST_BITS (8 MB); beyond that more of them pass to the exact join, nothing else changes.
BITMAP_BITS = 1 << 20
BITS_PER_WINDOW = 128
MOST_BITS = 1 << 26
#: Windows that may be broadcast (checked by a count); beyond, Spark shuffles the join.
BROADCAST_WINDOWS = 1_000_000


def words(text: Column) -> Column:
    """Words of ASCII letters and digits and all other characters; A-Z lower-cased; null: none."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SPLIT), "")


def _starts(count: Column, length: Column) -> Column:
    return F.when((count >= length) & (length > 0), F.sequence(F.lit(1), count - length + 1)).otherwise(F.array().cast("array<int>"))


def bitmap_bits(windows: int) -> int:
    """Size of the prefilter for a number of windows, a power of two."""
    return min(MOST_BITS, max(BITMAP_BITS, 1 << (BITS_PER_WINDOW * max(windows, 1) - 1).bit_length()))


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct window: ``w_len``, ``w_text``, ``w_hash`` and ``w_items`` (sorted ids as text)."""
    item = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    item = item.withColumn("len", F.least(F.size("w"), F.lit(n)))
    each = item.select("item", "len", F.explode(F.transform(
        _starts(F.size("w"), F.col("len")), lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))).alias("w_text"))
    each = each.groupBy(F.col("len").alias("w_len"), "w_text").agg(F.collect_set("item").alias("w_items"))
    return each.withColumn("w_hash", _text_hash(F.transform(F.split("w_text", " "), lambda w: F.xxhash64(w))))


def _text_hash(word_hashes: Column) -> Column:
    return F.xxhash64(word_hashes)


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, n_words, ``hit_at`` (sorted 1-based positions of hit words) and ``items``."""
    windows = saved(item_windows(benchmark, n), "windows")
    count = windows.count()
    few, size = count <= BROADCAST_WINDOWS, bitmap_bits(count)
    lengths = sorted(r[0] for r in windows.select("w_len").distinct().collect())  # at most n values
    # at most MOST_BITS / 64 numbers, as one constant array
    got = windows.select(F.pmod("w_hash", F.lit(size)).alias("bit")).groupBy(F.expr("bit div 64").cast("int").alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("v")).toArrow()
    cells = np.zeros(size // 64, np.int64)
    cells[got["cell"].to_numpy()] = got["v"].to_numpy()
    bit_of = F.split(F.lit(",".join(map(str, cells.tolist()))), ",").cast("array<bigint>")

    inner = docs.select(F.monotonically_increasing_id().alias("_row"),
                        *[F.col(c).alias(f"_keep_{c}") for c in keep], words(docs["text"]).alias("_w"))
    inner = inner.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    found = F.array().cast("array<struct<i:int,len:int,h:bigint>>")
    if lengths:
        def passes(x):
            bit = F.pmod(x["h"], F.lit(size))
            return F.get(bit_of, F.shiftright(bit, 6).cast("int")).bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))) != 0

        def of(length):
            at = F.transform(_starts(F.size("_h"), F.lit(length)), lambda i: F.struct(
                i.alias("i"), F.lit(length).alias("len"), _text_hash(F.slice("_h", i, length)).alias("h")))
            return F.filter(at, passes)

        found = F.concat(*[of(k) for k in lengths])
    found = F.transform(found, lambda x: F.struct(
        x["i"].alias("i"), x["len"].alias("len"), x["h"].alias("h"), F.array_join(F.slice("_w", x["i"], x["len"]), " ").alias("t")))
    rows = inner.select("_row", *[f"_keep_{c}" for c in keep], F.size("_w").alias("n_words"), F.explode_outer(found).alias("x"))
    side = F.broadcast(windows) if few else windows
    # a null x means that nothing passed; the document's row stays
    rows = rows.join(side, (F.col("x.h") == F.col("w_hash")) & (F.col("x.len") == F.col("w_len")) & (F.col("x.t") == F.col("w_text")), "left")
    span = F.when(F.col("w_hash").isNotNull(), F.sequence(F.col("x.i"), F.col("x.i") + F.col("x.len") - 1))
    return rows.groupBy("_row").agg(
        *[F.first(f"_keep_{c}").alias(c) for c in keep], F.first("n_words").cast("long").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(span)))).alias("hit_at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("w_items")))).alias("items"),
    ).drop("_row")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every document."""
    return hits(docs, benchmark, n).select(
        "doc_id", "n_words", F.size("hit_at").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_at") > 0).alias("contaminated"))


def _text_key(docs: DataFrame) -> list[Column]:
    return [F.xxhash64(F.coalesce(docs["text"], F.lit(""))), F.md5(F.coalesce(docs["text"], F.lit("")))]


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = N, mode: str = "document") -> DataFrame:
    """``docs`` without contaminated documents, or (mode "span") with their hit words cut out of the text.

    A cleaned text is its other words, lower-cased and joined by blanks; clean
    documents keep their text as it is. All columns are kept.
    """
    if mode not in ("document", "span"):
        raise ValueError("mode is document or span")
    key, at = private(docs, "_key", "_hit_at")
    texts = docs.select("text").withColumn("_key", _text_key(docs)[1])
    bad = hits(texts, benchmark, n, keep=("_key",)).filter(F.size("hit_at") > 0).select(F.col("_key").alias(key), F.col("hit_at").alias(at)).dropDuplicates([key])
    keyed = docs.withColumn(key, _text_key(docs)[1])
    if mode == "document":
        return keyed.join(bad.select(key), key, "left_anti").select(*docs.columns)
    left = F.array_join(F.filter(words(F.col("text")), lambda w, i: ~F.array_contains(at, i + 1)), " ")
    out = keyed.join(bad, key, "left")
    return out.select(*[F.when(F.col(at).isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(c) for c in docs.columns])
