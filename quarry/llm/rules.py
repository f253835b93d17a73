"""Quality rules by gradient-boosted trees over document statistics (operator 11).

One pass over the texts turns every document into a row of numbers (lengths,
marks, repeated lines and windows); everything after that reads those numbers
only. A fixed base rule drops what is too short or repeats itself; on the rest
the verdict is that of boosted trees fitted on labelled rows. The fit is a
histogram booster with logistic loss: features are cut into at most ``BINS``
bins, trees are complete to ``DEPTH``, and the score may only fall as one of
the ``FALLING`` features rises (a split that breaks this is not taken, and the
values below a split stay on their side of its middle). The trees are
flattened into arrays (trees x nodes) and all rows of a batch walk all trees
at once.

The fit sees at most ``SAMPLE`` labelled rows (those with the smallest hashes of
their ids), so the driver holds SAMPLE x features numbers. Words and windows
are compared by 64-bit hashes, lines as they are. Texts are read in pieces of
a megabyte; a task holds the word hashes of one text, or of texts of 512 KB.

Defined results: a null text has no words; a text without words has only
zeros and fails the base rule; a document labelled more than once counts as
good if any label says so; without labelled rows, or with one class only, the
trees keep every document; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved
from quarry.llm.textarrays import groups_of, mix, pieces, powers

SAMPLE = 20_000
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
ROUNDS, DEPTH, BINS = 80, 3, 64
RATE, RIDGE, LEAST_WEIGHT = 0.2, 1.0, 1.0
GROUP = 1 << 19
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "digit_share",
            "capital_share", "mark_share", "line_words", "top_word_share", "beyond_ascii_share"]
#: Features along which a document can only get worse.
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SPACE, _SYMBOL, _DIGIT, _CAPITAL, _MARK, _INNER = (np.zeros(256, bool) for _ in range(6))
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_DIGIT[48:58] = True
_CAPITAL[65:91] = True
_MARK[33:127] = True
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_MARK &= ~_SYMBOL
_INNER[0x80:0xC0] = True  # bytes after the first of a code point
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_VALUE[_SPACE] = 0
_ODD = mix(np.arange(301, 305, dtype=np.uint64)) | np.uint64(1)


def _words(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, hashes of the words as written, their offsets) of a buffer."""
    b = np.frombuffer(buf, np.uint8)
    space = _SPACE[b]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return b, np.empty(0, np.uint64), starts
    size = np.diff(starts, append=len(b))
    place = np.arange(starts[0], len(b)) - np.repeat(starts, size)
    with np.errstate(over="ignore"):
        return b, mix(np.add.reduceat(_VALUE[b[starts[0]:]] * powers(int(size.max()) + 1)[place], starts - starts[0])), starts


def _group_statistics(texts: list) -> tuple[np.ndarray, np.ndarray]:
    n = len(texts)
    sums = np.zeros((6, n), np.int64)  # code points in words, symbols, digits, capitals, marks, code points beyond ASCII
    found, owner = [], []
    for buf, docs, offs in pieces(texts):
        b, h, starts = _words(buf)
        point = ~_INNER[b]
        for row, mask in zip(sums, (point & ~_SPACE[b], _SYMBOL[b], _DIGIT[b], _CAPITAL[b], _MARK[b], point & (b >= 0x80))):
            np.add.at(row, docs, np.add.reduceat(mask, offs, dtype=np.int64))
        found.append(h)
        owner.append(docs[np.searchsorted(offs, starts, "right") - 1])
    h = np.concatenate(found) if found else np.empty(0, np.uint64)
    doc = np.concatenate(owner) if owner else np.empty(0, np.int64)
    words = np.bincount(doc, minlength=n)
    with np.errstate(over="ignore"):
        own = h + doc.astype(np.uint64) * _ODD[3]  # a word of one document
        kinds, many = np.unique(mix(own), return_counts=True, return_index=True)[1:]
        distinct = np.bincount(doc[kinds], minlength=n)
        top = np.zeros(n, np.int64)
        np.maximum.at(top, doc[kinds], many)
        again = np.zeros(len(h), bool)
        if len(h) > 2:
            window = mix(own[:-2] * _ODD[0] + h[1:-1] * _ODD[1] + h[2:] * _ODD[2])
            at = np.flatnonzero(doc[:-2] == doc[2:])
            _, inverse, times = np.unique(window[at], return_inverse=True, return_counts=True)
            at = at[times[inverse] > 1]
            for k in range(3):
                again[at + k] = True
    repeated = np.bincount(doc[again], minlength=n)
    lines, kept = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        written = [x for x in (t or b"").split(b"\n") if x.strip()]
        lines[i], kept[i] = len(written), len(set(written))
    base = np.column_stack([words, sums[0], sums[1], lines - kept, repeated])
    w, c, m = np.maximum(words, 1), np.maximum(sums[0], 1), np.maximum(lines, 1)
    return base, np.column_stack([np.log1p(words), sums[0] / w, sums[1] / c, (lines - kept) / m, repeated / w, distinct / w, sums[2] / c,
                                  sums[3] / c, sums[4] / c, words / m, top / w, sums[5] / c])


def statistics(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(BASE counts, FEATURES) of the texts (bytes or None), a row each."""
    parts = [_group_statistics(texts[part]) for part in groups_of(texts, GROUP)]
    if not parts:
        return np.zeros((0, len(BASE)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, the BASE counts and the FEATURES of every document: the only pass over the texts."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            base, x = statistics(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in base.T], *[pa.array(c) for c in x.T]], names=["doc_id", *BASE, *FEATURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        count, f"doc_id {kind}, " + ", ".join([f"{c} bigint" for c in BASE] + [f"{c} double" for c in FEATURES]))


@dataclass
class Trees:
    """Complete trees of one depth as arrays: inner nodes (trees x 2^depth - 1), leaf values (trees x 2^depth)."""

    prior: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document: all rows walk all trees, a level at a time."""
        total = np.full(len(x), self.prior)
        trees, inner = self.feature.shape
        if trees:
            row, tree = np.arange(len(x))[:, None], np.arange(trees)
            node = np.zeros((len(x), trees), np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
            total = total + self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _worth(g, h, w):
    return -(g * w + 0.5 * (h + RIDGE) * w * w)


def _split(g: np.ndarray, h: np.ndarray, low: float, high: float, direction: np.ndarray):
    """Best (feature, bin, gain, left value, right value) of a node from its histograms (features x bins)."""
    gl, hl = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
    gt, ht = g[0].sum(), h[0].sum()
    wl, wr = (np.clip(-a / (b + RIDGE), low, high) for a, b in ((gl, hl), (gt - gl, ht - hl)))
    here = np.clip(-gt / (ht + RIDGE), low, high)
    gain = _worth(gl, hl, wl) + _worth(gt - gl, ht - hl, wr) - _worth(gt, ht, here)
    allowed = (hl >= LEAST_WEIGHT) & (ht - hl >= LEAST_WEIGHT) & (direction[:, None] * (wr - wl) >= 0)
    gain = np.where(allowed, gain, 0.0)
    f, k = np.unravel_index(gain.argmax(), gain.shape)
    return int(f), int(k), float(gain[f, k]), float(wl[f, k]), float(wr[f, k])


def fit_trees(x: np.ndarray, y: np.ndarray, direction: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> Trees:
    """Boosted trees with logistic loss; ``direction`` is -1, 0 or 1 for each feature."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = y.mean() if len(y) else 1.0
    if not 0 < share < 1:
        return Trees(np.inf, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    code = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    trees = Trees(float(np.log(share / (1 - share))), np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves)))
    margin = np.full(len(y), trees.prior)
    cell = code + BINS * np.arange(x.shape[1])
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        value = {0: 0.0}
        for at in range(inner):
            low, high = bounds[at]
            rows = np.flatnonzero(node == at)
            bounds[2 * at + 1] = bounds[2 * at + 2] = low, high
            value[2 * at + 1] = value[2 * at + 2] = value[at]
            shape = (x.shape[1], BINS)
            hist = [np.bincount(cell[rows].ravel(), np.repeat(v[rows], x.shape[1]), minlength=cell.shape[1] * BINS).reshape(shape) for v in (g, h)]
            f, k, gain, left, right = _split(*hist, low, high, direction)
            if gain > 1e-9 and k < len(edges[f]):
                trees.feature[r, at], trees.threshold[r, at] = f, edges[f][k]
                value[2 * at + 1], value[2 * at + 2] = left, right
                if direction[f]:
                    middle = (left + right) / 2
                    under, over = (low, middle), (middle, high)
                    bounds[2 * at + 1], bounds[2 * at + 2] = (under, over) if direction[f] > 0 else (over, under)
            node[rows] = 2 * at + 1 + (x[rows, trees.feature[r, at]] > trees.threshold[r, at])
        trees.value[r] = [RATE * value[inner + i] for i in range(leaves)]
        margin += trees.value[r][node - inner]
    return trees


def train(described: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Fit on at most ``sample`` described documents with a label."""
    good = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").cast("int").alias("good"))
    rows = described.join(good, described["doc_id"] == good["labelled"]).select("good", *FEATURES, F.xxhash64("doc_id", F.lit(23)).alias("h"))
    got = rows.orderBy("h", "good", *FEATURES).limit(sample).toArrow()
    x = np.column_stack([got[c].to_numpy() for c in FEATURES])
    return fit_trees(x, got["good"].to_numpy().astype(float), np.array([-1 if c in FALLING else 0 for c in FEATURES]))


def apply_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the BASE counts, base_failed, kept, score and the FEATURES of every document."""
    rows = saved(describe(docs), "rules")
    trees = train(rows, labels, sample)

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at = 1 + len(BASE)
        for batch in batches:
            score = trees.score(np.column_stack([batch.column(at + i).to_numpy() for i in range(len(FEATURES))]))
            words, repeated = batch.column(1).to_numpy(), batch.column(len(BASE)).to_numpy()
            failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)
            columns = [*batch.columns[:at], pa.array(failed), pa.array(~failed & (score >= 0.5)), pa.array(score), *batch.columns[at:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *BASE, "base_failed", "kept", "score", *FEATURES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, score double, " + ", ".join(f"{c} double" for c in FEATURES))
