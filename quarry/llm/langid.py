"""Language identification with string kernels (operator 7).

The blended-spectrum presence kernel counts the byte n-grams (n = 2, 3, 4) that
two texts share, hashed to DIM places and divided by the texts' norms. A
sample of at most SAMPLE labelled texts, balanced over languages, fits kernel
ridge regression, one language against the rest, on LANDMARKS of its texts
(Nystroem). Every whole text is then scored by two batched matrix products:
texts x landmarks, landmarks x languages.

Only the bounded sample (as bit vectors) reaches the driver, and only the
landmark and weight matrices (fixed size) are sent to the tasks; the scan has
no shuffle. Defined results: null text and text without a letter are ``und``
with score 0; without any labelled text every language is ``und``; ties go to
the first language by code point; repeated rows are scored each; other columns
are ignored. A null ``lang`` is never learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fold, saved
from quarry.llm.textarrays import PIECE

DIM = 1 << 13
ORDERS = (2, 3, 4)
SAMPLE = 4000
LANDMARKS = 128
RIDGE = 1e-2
ROWS = 64  # texts per presence matrix
_FOLD = np.full(256, 32, np.uint8)  # ASCII other than letters: blank
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def presence(texts: list, dim: int = DIM, orders=ORDERS) -> np.ndarray:
    """0/1 matrix texts x dim. Letters of ASCII and Latin-1 are case-folded; long texts are read in pieces that overlap."""
    out = np.zeros((len(texts), dim), np.uint8)
    overlap = max(orders) - 1
    for row, text in zip(out, texts, strict=True):
        text = text or b""
        for lo in range(0, max(len(text), 1), PIECE):
            b = np.frombuffer(text[max(lo - overlap, 0):lo + PIECE], np.uint8)
            b = np.concatenate([[np.uint8(32)], _FOLD[b], [np.uint8(32)]])
            upper = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)) + 1
            b[upper] += 32
            wide = b.astype(np.uint32)
            with np.errstate(over="ignore"):
                h = wide
                for n in range(2, max(orders) + 1):
                    h = h[:-1] * np.uint32(0x01000193) ^ wide[n - 1:]
                    if n in orders:
                        row[(h * np.uint32(0x9E3779B1)) >> np.uint32(32 - dim.bit_length() + 1)] = 1
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their norm, so that products are normalised kernels."""
    x = x.astype(np.float32)
    norm = np.sqrt(x.sum(1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


class Model:
    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def margins(self, texts: list) -> np.ndarray:
        out = np.empty((len(texts), len(self.languages)), np.float32)
        for lo in range(0, len(texts), ROWS):
            out[lo:lo + ROWS] = (unit(presence(texts[lo:lo + ROWS])) @ self.landmarks) @ self.weights
        return out


def fit_rows(langs: list[str], bits: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """``bits``: packed presence rows. Landmarks are taken in turn from each language's texts."""
    languages = sorted(set(langs))
    which = np.array([languages.index(x) for x in langs])
    rank = np.empty(len(which), np.int64)
    for k in range(len(languages)):
        own = np.flatnonzero(which == k)
        rank[own] = np.arange(len(own))
    chosen = np.lexsort((which, rank))[:landmarks]
    z = unit(np.unpackbits(bits[chosen], axis=1))
    kernel = np.concatenate([unit(np.unpackbits(bits[lo:lo + 256], axis=1)) @ z.T for lo in range(0, len(bits), 256)]).astype(np.float64)
    goal = np.where(which[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1.0 / np.bincount(which)[which]  # languages weigh the same
    left = kernel.T @ (kernel * weight[:, None]) + ridge / len(kernel) * (z @ z.T) + 1e-9 * np.eye(len(z))
    alpha = np.linalg.solve(left, kernel.T @ (goal * weight[:, None]))
    return Model(languages, np.ascontiguousarray(z.T), alpha.astype(np.float32))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on labelled rows outside fold 1. ``sample`` bounds the rows fitted (in expectation, and by a limit at 1.5 times)."""
    rows = docs.filter(F.col("lang").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return None
    each = max(1, sample // len(counts))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))])
    at = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
    chosen = rows.filter(at < F.get(F.map_values(F.map_filter(share, lambda k, _: k == F.col("lang"))), 0))

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo in range(0, len(texts), ROWS):
                found = np.packbits(presence(texts[lo:lo + ROWS]), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, ROWS), batch.column(2).slice(lo, ROWS), pa.array([x.tobytes() for x in found], pa.binary())],
                                                 names=["lang", "at", "bits"])

    got = saved(chosen.select("lang", F.coalesce("text", F.lit("")).cast("binary"), F.xxhash64("doc_id").alias("at")).mapInArrow(
        pack, "lang string, at bigint, bits binary"), "langid").orderBy("at", "lang", "bits").limit(sample * 3 // 2).toArrow()
    if not got.num_rows:
        return None
    bits = np.frombuffer(b"".join(got["bits"].to_pylist()), np.uint8).reshape(got.num_rows, -1)
    return fit_rows(got["lang"].to_pylist(), bits)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document."""
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("text").cast("binary").alias("text"),
                       F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("letters"))

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            lang, certain = np.full(n, "und", object), np.zeros(n)
            read = np.flatnonzero(batch.column(3).to_numpy(zero_copy_only=False))
            if model is not None and len(read):
                texts = batch.column(2).take(pa.array(read)).to_pylist()
                margin = model.margins(texts)
                best = margin.argmax(1)
                lang[read] = np.array(model.languages, object)[best]
                certain[read] = np.clip((margin[np.arange(len(best)), best].astype(float) + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(certain)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
