"""Toxicity by Levenshtein automata over a lexicon trie (operator 6).

The lexicon (terms and stems with their log-odds) is learned from a bounded
sample of labelled texts outside the held-out fold. Its trie is intersected
with a Levenshtein automaton of one edit (terms of EDIT_FROM bytes or more) and
made deterministic once: a table state x byte class. The words of a batch run
through the table side by side, one byte per step; most leave it after a few
bytes. Each hit is then read in its context window: log-odds of the words
around it, and quotation marks or words of reporting near it, which tell a
quoted term from abuse. A logistic model over the summed features gives the
score.

Only sums over the sample reach the driver (terms whose evidence passes a
threshold, so fewer than the sample has words; one feature row per sampled
text), and only the automata and weights go to the tasks; scoring has no
shuffle. A lexicon of more than PART_BYTES is split over several automata, so
one table stays below some 100,000 states; a term has at most TERM_BYTES.
Learning and scoring read the same lower-cased text. Defined results: null and
empty texts score like a text without hits; without labels every score is 0;
without toxic labels the lexicon is empty; repeated rows are scored each;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fold, saved
from quarry.llm.textarrays import groups_of, mix, pieces, powers

SAMPLE = 20_000
#: Bytes of terms that one automaton holds.
PART_BYTES = 1 << 12
TERM_BYTES = 1 << 10
EDIT_FROM = 5
STEM = (4, 5, 6, 7)
WINDOW = 6
THRESHOLD = 0.7
CONTEXT_BITS = 12
#: Words of reporting that mark a quotation when they stand near a term.
REPORTING = "said says wrote writes called calls word term quote quoted quotes sagte schrieb nannte wort dijo escribe palabra dit disait mot".split()
NONE, EXACT, FUZZY, STEM_HIT = 0, 1, 2, 3

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_MARKS = np.isin(np.arange(256), np.frombuffer(b"\"'", np.uint8))
_MARKS[0xAB] = _MARKS[0xBB] = _MARKS[0x9C] = _MARKS[0x9D] = _MARKS[0x9E] = True  # last bytes of typographic marks


class Automaton:
    """Deterministic table of the trie's words within the allowed edits.

    ``terms``: text -> weight. A key that ends in ``*`` is a stem: any word
    that starts with it is a hit (no edits) unless it is a term or, where edits
    are allowed, one edit away from one.
    """

    def __init__(self, terms: dict[str, float]):
        self.keys = sorted(terms)
        self.weights = np.array([0.0] + [terms[k] for k in self.keys])
        children: list[dict[int, int]] = [{}]
        ends: list[tuple[int, bool, bool] | None] = [None]  # term number, stem, edits allowed
        editable = [False]
        stems: dict[int, int] = {}
        for i, key in enumerate(self.keys, 1):
            word = key.rstrip("*").encode()
            at = 0
            stem = key.endswith("*")
            for b in word:
                if b not in children[at]:
                    children[at][b] = len(children)
                    children.append({})
                    ends.append(None)
                    editable.append(False)
                editable[at] |= not stem and len(word) >= EDIT_FROM
                at = children[at][b]
            if stem:
                stems[at] = i
            else:
                ends[at] = (i, stem, len(word) >= EDIT_FROM)
                editable[at] |= len(word) >= EDIT_FROM
        letters = sorted({b for c in children for b in c})
        self.classes = np.zeros(256, np.int64)
        for k, b in enumerate(letters, 1):
            self.classes[b] = k

        def close(states):
            """Deletions: a letter of the term is skipped."""
            out = set(states)
            out |= {(c, 1) for a, e in states if e == 0 and editable[a] for c in children[a].values() if editable[c]}
            return frozenset(out)

        def step(state, b):
            states, stem = state
            out = set()
            for a, e in states:
                if b in children[a]:
                    out.add((children[a][b], e))
                if e == 0 and editable[a]:
                    out.add((a, 1))  # a letter too many
                    out |= {(c, 1) for x, c in children[a].items() if x != b and editable[c]}
            # a state reached without edits covers the same state with one
            out = close({(a, e) for a, e in out if e == 0 or (a, 0) not in out})
            # the stem the word began with is kept while longer terms are still possible
            return out, next((stems[a] for a, e in sorted(out) if e == 0 and a in stems), stem)

        start = close({(0, 0)}), 0
        number, table, outcome, kind = {(frozenset(), 0): 0, start: 1}, [[0] * (len(letters) + 1)], [0, 0], [NONE, NONE]
        todo = [start]
        while todo:
            state = todo.pop(0)
            row = []
            for b in [None, *letters]:
                nxt = step(state, b)
                if nxt not in number:
                    number[nxt] = len(number)
                    states, stem = nxt
                    hit = min(((e, ends[a][0]) for a, e in states if ends[a] and (e == 0 or ends[a][2])), default=None)
                    outcome.append(hit[1] if hit else stem)
                    kind.append((EXACT if hit[0] == 0 else FUZZY) if hit else STEM_HIT if stem else NONE)
                    todo.append(nxt)
                row.append(number[nxt])
            table.append(row)
        self.table = np.array(table, np.int32)
        self.outcome, self.kind = np.array(outcome), np.array(kind)
        self.final = np.array([i for i, r in enumerate(table) if (np.array(r) == i).all()])

    def run(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term number, kind) of every word; all words take a step at a time."""
        state = np.ones(len(starts), np.int32)
        cls = self.classes[b]
        stays = np.zeros(len(self.table), bool)
        stays[self.final] = True
        live, p = np.arange(len(starts)), 0
        while len(live):
            live = live[starts[live] + p < ends[live]]
            nxt = self.table[state[live], cls[starts[live] + p]]
            state[live] = nxt
            live = live[~stays[nxt]]
            p += 1
        return self.outcome[state], self.kind[state]


class Lexicon:
    """Automata that hold the terms together; a word counts as its best hit: exact, then one edit, then stem."""

    def __init__(self, terms: dict[str, float], part_bytes: int = PART_BYTES):
        parts: list[list[str]] = [[]]
        size = 0
        for key in sorted(terms):
            if parts[-1] and size + len(key.encode()) > part_bytes:
                parts.append([])
                size = 0
            parts[-1].append(key)
            size += len(key.encode())
        self.parts = [Automaton({k: terms[k] for k in part}) for part in parts]
        self.keys = [k for a in self.parts for k in a.keys]
        self.weights = np.concatenate([[0.0], *[a.weights[1:] for a in self.parts]])

    def run(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term number, kind) of every word."""
        term, kind, before = None, None, 0
        for part in self.parts:
            t, k = part.run(b, starts, ends)
            t = np.where(t > 0, t + before, 0)
            if term is None:
                term, kind = t, k
            else:
                better = (k > 0) & ((kind == 0) | (k < kind))
                term, kind = np.where(better, t, term), np.where(better, k, kind)
            before += len(part.keys)
        return term, kind


def split_words(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and starts and ends of the runs of letters, digits and non-ASCII bytes."""
    b = _FOLD[np.frombuffer(buf, np.uint8)]
    b[np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)) + 1] += 32  # accented capitals of Latin-1
    inside = _IN_WORD[b]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    return b, edge[::2], edge[1::2]


def _hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CONTEXT_BITS-bit hashes of some words of a buffer."""
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        value = _VALUE[b[np.repeat(starts, size) + place]] * powers(int(size.max()))[place]
        return (mix(np.add.reduceat(value, first)) >> np.uint64(64 - CONTEXT_BITS)).astype(np.int64)


_REPORTING = np.zeros(1 << CONTEXT_BITS, bool)
for _w in REPORTING:
    _REPORTING[_hashes(np.frombuffer(_w.encode(), np.uint8), np.array([0]), np.array([len(_w)]))] = True
N_FEATURES = 10


def read_hits(texts: list, auto: Automaton | Lexicon) -> Iterator[tuple]:
    """(text number, term, kind, quoted, words of the piece, hashes of the window's words) of every hit; (text, 0, 0, 0, words, ()) once per piece."""
    for part in groups_of(texts):
        for buf, docs, offs in pieces(texts[part]):
            b, starts, ends = split_words(buf)
            where = np.searchsorted(offs, starts, "right") - 1
            words = np.bincount(where, minlength=len(docs))
            for d, n in zip(docs, words, strict=True):
                yield part.start + int(d), 0, 0, 0, float(n), ()
            term, kind = auto.run(b, starts, ends)
            hits = np.flatnonzero(term)
            if not len(hits):
                continue
            # all words of all windows, a column per place
            near = hits[:, None] + np.array([j for j in range(-WINDOW, WINDOW + 1) if j])
            inside = (near >= 0) & (near < len(starts))
            near = np.clip(near, 0, len(starts) - 1)
            inside &= where[near] == where[hits][:, None]
            used, slot = np.unique(near, return_inverse=True)
            hashed = _hashes(b, starts[used], ends[used])[slot.reshape(near.shape)]
            marks = np.cumsum(np.append(0, _MARKS[b]))
            lo = np.where(inside, near, hits[:, None]).min(1)
            hi = np.where(inside, near, hits[:, None]).max(1)
            before = marks[starts[hits]] - marks[np.maximum(starts[lo] - 1, 0)]
            after = marks[np.minimum(ends[hi] + 1, len(b))] - marks[ends[hits]]
            quoted = ((before > 0) & (after > 0)) | (_REPORTING[hashed] & inside).any(1)
            for i, h in enumerate(hits):
                yield part.start + int(docs[where[h]]), int(term[h]), int(kind[h]), int(quoted[i]), 0.0, hashed[i][inside[i]]


def features(texts: list, auto: Automaton | Lexicon, context: np.ndarray) -> np.ndarray:
    """One row per text: counts of its exact, misspelled and stem hits, plain and quoted, their weights, their context, and their share of the words."""
    out = np.zeros((len(texts), N_FEATURES))
    words = np.zeros(len(texts))
    for d, term, kind, quoted, n, around in read_hits(texts, auto):
        if not term:
            words[d] += n
            continue
        out[d, 2 * (kind - 1) + quoted] += 1
        out[d, 6 if kind == EXACT else 7] += auto.weights[term] * (not quoted)
        out[d, 8] += float(context[around].mean()) if len(around) else 0.0
    hits = out[:, :6].sum(1)
    out[:, 8] /= np.maximum(hits, 1)
    out[:, 9] = 10 * hits / np.maximum(words, 1)
    out[:, :8] = np.log1p(np.maximum(out[:, :8], 0))
    return out


class Model:
    def __init__(self, auto: Automaton | Lexicon, context: np.ndarray, beta: np.ndarray):
        self.auto, self.context, self.beta = auto, context, beta

    def score(self, texts: list) -> np.ndarray:
        x = features(texts, self.auto, self.context)
        return 1 / (1 + np.exp(-np.clip(x @ self.beta[1:] + self.beta[0], -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Newton steps; the intercept is not penalised."""
    x1 = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    beta = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -40, 40)))
        slope = x1.T @ (p - y) + penalty @ beta
        beta -= np.linalg.solve(x1.T @ (x1 * (p * (1 - p) + 1e-9)[:, None]) + penalty, slope)
        if np.abs(slope).max() < 1e-8:
            break
    return beta


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Words and stems that toxic texts have far more often, with their log-odds.

    Text frequencies per word come from one aggregate. A stem's frequency is
    the sum over its words but the most frequent toxic one, which must not be
    its only evidence; of stems that share a beginning the one with the
    strongest evidence is kept, beside the words.
    """
    words = F.array_remove(F.split(F.lower("text"), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")
    texts = sample.select("toxic", words.alias("ws")).filter(F.size("ws") > 0)
    # near copies count once: they mostly share their five-word shingle of least hash
    at = F.sequence(F.lit(1), F.greatest(F.size("ws") - 4, F.lit(1)))
    texts = texts.withColumn("kin", F.array_min(F.transform(at, lambda i: F.xxhash64(F.slice("ws", i, 5)))))
    texts = texts.groupBy("kin", "toxic").agg(F.min("ws").alias("ws")).withColumn("ws", F.array_distinct("ws"))
    seen = texts.select("toxic", F.explode("ws").alias("w")).filter(F.octet_length("w") <= TERM_BYTES)
    freq = saved(seen.groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "tox-words")
    rate = n_toxic / max(1, n_toxic + n_clean)
    surely = float(np.log(100.0 * max(1, freq.count())))

    def odds(t, c):
        return F.log((t + 0.5) / F.lit(n_toxic + 1.0)) - F.log((c + 0.5) / F.lit(n_clean + 1.0))

    # log-likelihood ratio against chance, over all words tried
    t, c = F.col("t"), F.col("c")
    excess = t * F.log(t / ((t + c) * rate)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - rate)))).otherwise(0.0)
    pure = (t >= 3) & (t * n_clean > 3 * c * n_toxic) & (excess > surely)
    stems = freq.select("w", "t", "c", F.explode(F.array(*[F.lit(k) for k in STEM])).alias("k")).filter(F.length("w") > F.col("k"))
    stems = stems.groupBy(F.substring("w", F.lit(1), F.col("k")).alias("w")).agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count("*").alias("forms"), F.max(F.struct("t", (-c).alias("m"))).alias("top"))
    stems = stems.select("w", (t - F.col("top.t")).alias("t"), (c + F.col("top.m")).alias("c"), "forms")
    stems = stems.filter((t >= 8) & (t * n_clean > 4 * c * n_toxic) & (excess > surely) & (F.col("forms") >= 4)).select(F.concat("w", F.lit("*")).alias("w"), "t", "c")
    best = freq.filter(pure).select("w", "t", "c").union(stems).withColumns({"o": odds(t, c), "x": excess})
    rows = [(r["w"], float(r["o"])) for r in best.orderBy(F.desc("x"), F.desc(F.length("w")), "w").collect()]  # as many as pass the threshold
    kept: list[str] = []  # stems, the strongest of those that share a beginning
    for w, _ in rows:
        if w.endswith("*") and not any(w[:-1].startswith(k) or k.startswith(w[:-1]) for k in kept):
            kept.append(w[:-1])
    entries = [(w, o) for w, o in rows if not w.endswith("*") or w[:-1] in kept]
    return dict(entries)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` labelled rows (in expectation) outside fold 1."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    usable = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = usable.count()
    if not n:
        return None
    at = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    chosen = usable.filter(at < min(1.0, sample / n)).limit(sample * 3 // 2)
    rows = saved(docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("_id")).select(F.coalesce(docs["text"], F.lit("")).alias("text"), "toxic", "_id"), "tox-sample")
    counts = Counter({r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()})
    auto = Lexicon(learn_lexicon(rows, counts[1], counts[0]))

    def window_words(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((2, 1 << CONTEXT_BITS), np.int64)
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            for d, term, _, _, _, around in read_hits(batch.column(0).to_pylist(), auto):
                if term:
                    np.add.at(total[toxic[d]], around, 1)
        cls, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(cell), pa.array(total[cls, cell])], names=["toxic", "cell", "n"])

    binary = rows.select(F.lower("text").cast("binary").alias("text"), "toxic")
    got = binary.mapInArrow(window_words, "toxic bigint, cell bigint, n bigint").groupBy("toxic", "cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((2, 1 << CONTEXT_BITS))
    total[got["toxic"].to_numpy(), got["cell"].to_numpy()] = got["n"].to_numpy()
    context = np.zeros(1 << CONTEXT_BITS)
    if total[0].sum() and total[1].sum():
        context = np.log((total[1] + 5) / (total[1].sum() + 5 * total.shape[1])) - np.log((total[0] + 5) / (total[0].sum() + 5 * total.shape[1]))

    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = features(batch.column(0).to_pylist(), auto, context)
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int64()), *[pa.array(c) for c in x.T]], names=["toxic", *[f"x{i}" for i in range(N_FEATURES)]])

    rows = binary.mapInArrow(describe, "toxic bigint, " + ", ".join(f"x{i} double" for i in range(N_FEATURES)))
    # texts with the same features are one weighted row
    got = rows.groupBy(*rows.columns).count().orderBy(*rows.columns).toArrow()
    y, w = got["toxic"].to_numpy(), got["count"].to_numpy()
    x = np.column_stack([got[f"x{i}"].to_numpy() for i in range(N_FEATURES)])
    return Model(auto, context, fit_logistic(np.repeat(x, w, axis=0), np.repeat(y, w)))


def predict(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.lower("text").cast("binary").alias("text"))

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = np.zeros(batch.num_rows) if model is None else model.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, train(docs, labels))
