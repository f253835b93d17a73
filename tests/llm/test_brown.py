from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import brown as B
from quarry.llm import textarrays as TA
from tests.llm.conftest import fold, tokens


def test_word_hashes_follow_the_tokens():
    texts = [b"The the THE cat", None, b"", b" \t\x0b", "Été été".encode(), b"a" * 3_000_000 + b" end", b"x\ny\rz"]
    h, n = TA.doc_words(texts)
    want = [tokens((t or b"").decode()) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    name = {}
    for w, x in zip(flat, h.tolist(), strict=True):
        assert name.setdefault(w, x) == x
    assert len(set(name.values())) == len(name)


def test_texts_longer_than_a_piece_are_cut_at_words(monkeypatch):
    monkeypatch.setattr(TA, "PIECE", 64)
    texts = [(" ".join(f"word{i}" for i in range(k))).encode() for k in (0, 1, 40, 400)]
    h, n = TA.doc_words(texts)
    monkeypatch.setattr(TA, "PIECE", 1 << 20)
    h2, n2 = TA.doc_words(texts)
    assert n.tolist() == n2.tolist() == [0, 1, 40, 400] and (h == h2).all()


def test_counts_and_base_score(odd_docs, doc_rows):
    out = B.score(odd_docs, sweeps=2)
    assert out.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    c = Counter()
    for r in doc_rows:
        if fold(r[0], 7) != 2:
            c.update([*tokens(r[1]), None])
    n, v = sum(c.values()), len(c)
    want = sorted((str(r[0]), fold(r[0], 7) == 2, len(tokens(r[1])) + 1, sum(c[w] > 0 for w in [*tokens(r[1]), None]), n,
                   round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in [*tokens(r[1]), None]), 5)) for r in doc_rows)
    rows = out.collect()
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows)
    assert got == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def by_hash(text):
    return TA.doc_words([text.encode()])[0].tolist()


@pytest.fixture(scope="module")
def skewed(spark):
    """Texts over words of falling frequency, with some null and empty texts, and words of held-out texts alone."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 900) + f" only{i}") for i in range(300)]
    rows += [(1000, None), (1001, ""), (1001, "w1 w1 w1 w2")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_words_at_hand_change_no_result(skewed, monkeypatch):
    monkeypatch.setattr(B, "HEAD", 20)
    monkeypatch.setattr(B, "PIECE_TOKENS", 500)
    monkeypatch.setattr(B, "BLOCK_WORDS", 16)
    want = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in B.score(skewed[1], sweeps=4).collect())
    for few in (40, 200):
        got = sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in B.score(skewed[1], sweeps=4, at_hand=few).collect())
        assert [x[:3] for x in got] == [x[:3] for x in want]
        assert np.allclose([x[3:] for x in got], [x[3:] for x in want], rtol=1e-12)


def test_scores_by_brute_force(skewed, monkeypatch):
    """Every sweep and score again in plain Python: all bigrams in a dictionary, likelihood by its definition, words moved one by one."""
    rows, docs = skewed
    monkeypatch.setattr(B, "HEAD", 20)
    monkeypatch.setattr(B, "PIECE_TOKENS", 500)
    monkeypatch.setattr(B, "BLOCK_WORDS", 16)
    got = {(r["doc_id"], r["n_tokens"]): r["score"] for r in B.score(docs, sweeps=3, at_hand=60).collect()}
    k, end, shared = B.CLASSES, "end", "shared"
    train = [by_hash(t or "") for i, t in rows if fold(i, 7) != 2]
    count = Counter(w for t in train for w in t)
    order = sorted(count, key=lambda w: (-count[w], w))
    placed = [w for w in order if count[w] >= B.LEAST]
    unit = lambda w: w if w == end or count.get(w, 0) >= B.LEAST else shared
    pairs = Counter((a, b) for t in train for u in [[unit(w) for w in t]] for a, b in zip([end, *u], [*u, end], strict=True))
    cls = {w: min(i, k - 1) for i, w in enumerate(placed)} | {shared: k - 1, end: k}

    def table(c):
        n = np.zeros((k + 1, k + 1))
        for (a, b), x in pairs.items():
            n[c[a], c[b]] += x
        return n

    of = {w: [(p, x) for p, x in pairs.items() if w in p] for w in [*placed, shared]}

    def best(w, c, n):
        """The class with the highest likelihood of all bigrams, the word moved alone. ``n``: the table of ``c``, which becomes that of the move."""
        def add(at, sign):
            for (a, b), x in of[w]:
                n[at if a == w else c[a], at if b == w else c[b]] += sign * x

        found = []
        add(c[w], -1)
        np.maximum(n, 0, out=n)
        for b in range(k):
            add(b, 1)
            found.append(round(B.likelihood(n), 7))
            add(b, -1)
        add(best := int(np.argmax(found)), 1)
        return best

    seen = None
    for sweep in range(4):
        n = table(cls)
        if seen is None or B.likelihood(n) > seen[0]:
            seen = B.likelihood(n), cls, n
        if sweep == 3:
            break
        new, weight, moving = dict(cls), Counter(), n.copy()
        for (_, b), x in pairs.items():
            weight[b] += x
        head = [(w, i) for i, w in enumerate(placed[:20])] + [(shared, 20)] * (weight[shared] > 0)
        for w, i in sorted(head, key=lambda x: (-weight[x[0]], x[1])):
            if not ((i * 2654435761 >> 7) + sweep & 1 and sweep):
                new[w] = best(w, cls, moving)  # neighbours as at the sweep's start
        for w in placed[20:] if sweep else []:
            if sweep == 1 or (w >> 40) + sweep & 1 == 0:
                new[w] = best(w, cls, n.copy())
        cls = new
    _, cls, n = seen
    rare = sum(count[w] < B.LEAST for w in count)
    tokens = n.sum(0)
    prior = (tokens + 1) / (tokens.sum() + k + 1)
    mass = tokens.copy()
    mass[cls[shared]] += 0 if rare else B.DISCOUNT
    for i, t in rows:
        u = by_hash(t or "")
        c, want = [k, *[cls[unit(w)] for w in u], k], 0.0
        for a, b in zip(c, c[1:], strict=False):
            want += np.log10((n[a, b] + B.PRIOR * prior[b]) / (n[a].sum() + B.PRIOR))
        for w in u:
            x = count.get(w, 0)
            want += np.log10((x - B.DISCOUNT * (x < B.LEAST) if x else B.DISCOUNT * max(rare, 1)) / mass[cls[unit(w)]])
        assert got[i, len(u) + 1] == pytest.approx(want, rel=1e-9)


def test_terms_read_from_a_table_give_the_same_gains():
    rng = np.random.default_rng(4)
    sums = rng.poisson(0.5, (300, B.CELLS)).astype(float)
    bigrams = rng.integers(0, 90, (B.SIDE, B.SIDE)).astype(float)
    cls = rng.integers(0, B.CLASSES, 300)
    for x, a in zip(sums, cls, strict=True):  # every word is in the bigrams
        bigrams[:, a] += x[:B.SIDE]
        bigrams[a] += x[B.SIDE:-1]
        bigrams[a, a] += x[-1]
    assert np.allclose(B.read_gains(sums, cls, bigrams, B.added_terms(bigrams)), B.dense_gains(sums, cls, bigrams), atol=1e-7)


def test_messages_in_any_parts_give_the_same_sums():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rows, want = [], {}
    for piece in range(60):
        h = np.unique(rng.integers(0, 12, rng.integers(1, 9))).astype(np.uint64)
        slot = np.where(h % 2 == 0, rng.integers(0, 99, len(h)), -1 - h.astype(np.int64)).astype(np.int32)
        n = rng.integers(0, 4, len(h)).astype(np.int32)
        pairs = rng.integers(0, B.CELLS, (n.sum(), 2)).astype(np.uint8)
        rows.append([0, piece, *(x.tobytes() for x in (h, slot, (h % 5).astype(np.uint8), n, pairs))])
        for w, x, p in zip(h.tolist(), slot.tolist(), np.split(pairs, np.cumsum(n)[:-1]), strict=True):
            sums, asked = want.setdefault(w, (np.zeros(B.CELLS), set()))
            np.add.at(sums, p[:, 0], p[:, 1])
            asked.add((piece, x) if x >= 0 else x)
    whole = pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < 2 else pa.binary()) for i, c in enumerate(zip(*rows, strict=True))], names=list("abcdefg"))
    for cuts in ([], [1, 2, 30, 59], list(range(1, 60))):
        held = None
        for lo, hi in zip([0, *cuts], [*cuts, 60], strict=True):
            w = B._words(whole.slice(lo, hi - lo))
            held = w.after(held) if held is not None else w
        assert held.h.tolist() == sorted(want)
        for part in (held, held.part(slice(3, None))):
            for j, w in enumerate(part.h.tolist()):
                mine = part.word == j
                asked = [(p, x) if x >= 0 else x for p, x in zip(part.piece[mine].tolist(), part.slot[mine].tolist(), strict=True)]
                assert (part.sums[j] == want[w][0]).all() and part.cls[j] == w % 5
                assert len(asked) == len(set(asked)) and set(asked) == want[w][1]


def test_sweeps_raise_likelihood_and_model_beats_unigrams(spark):
    # two kinds of words that alternate: classes know what follows, single counts do not
    rng = np.random.default_rng(2)
    a, b = [f"noun{i}" for i in range(150)], [f"verb{i}" for i in range(150)]
    rows = [(i, " ".join(w for _ in range(40) for w in (rng.choice(a), rng.choice(b)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    cluster = B.cluster
    try:
        B.cluster = lambda *args: seen.append(cluster(*args)) or seen[-1]
        out = B.score(docs).filter("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    finally:
        B.cluster = cluster
    path = seen[0][2]
    assert max(path) > path[0]
    assert (out["s"] - out["b"]) / out["n"] > 0.15  # close to log10 2 for the class of every word


def test_probabilities_sum_to_one(spark):
    rows = [(i, f"the cat {i % 5} sat on the mat {i % 3}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = [r for r in rows if fold(r[0], 7) != 2]
    vocabulary = sorted({w for _, t in train for w in t.split()})
    # one-token texts: every known word, the end alone, and an unknown word in each bucket's class
    probe = [(1000 + i, w) for i, w in enumerate(vocabulary)] + [(2000, "")]
    probe = [(next(k for k in range(i * 7_000, i * 7_000 + 7_000) if fold(k, 7) == 2), t) for i, t in probe]
    got = {r["doc_id"]: r["score"] for r in B.score(docs.union(spark.createDataFrame(probe, "doc_id long, text string")), sweeps=1).collect()}
    # P(w) * P(end | w) for known words plus P(end) leaves room for unknown words only
    assert 0 < sum(10 ** got[i] for i, _ in probe) < 1


def test_empty_and_untrained(spark, no_docs):
    assert B.score(no_docs).count() == 0
    held = next(k for k in range(100) if fold(k, 7) == 2)
    r = B.score(spark.createDataFrame([(held, "only held out")], "doc_id long, text string"), sweeps=1).first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and np.isfinite(r["score"])


@pytest.fixture(scope="module")
def two_kinds(spark):
    """Nouns and verbs that alternate. The held-out texts have only words outside the 4096 most frequent, whose hashes end in the same few bits."""
    rng = np.random.default_rng(5)
    train, held = ([i for i in range(800) if (fold(i, 7) == 2) == h] for h in (False, True))
    sides, tails = [], []
    for kind in ("noun", "verb"):
        names = [f"{kind}{i}" for i in range(60_000)]
        low = TA.doc_words([" ".join(names).encode()])[0] & np.uint64(4095)
        tail = [w for w, b in zip(names, low, strict=True) if b < 12][:100]
        filler = [w for w, b in zip(names, low, strict=True) if b >= 12][:2100]
        words = [*(filler * 14), *(tail * 8), *([f"{kind}-{i}" for i in range(20)] * 1500)]
        sides.append(np.array_split(rng.permutation(words), len(train)))
        tails.append(tail)
    rows = [(i, " ".join(w for pair in zip(a, b, strict=True) for w in pair)) for i, a, b in zip(train, *sides, strict=True)]
    rows += [(i, " ".join(rng.choice(t) for _ in range(50) for t in tails)) for i in held]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def tail_gain(docs):
    r = B.score(docs, sweeps=4).filter("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    return (r["s"] - r["b"]) / r["n"]


def test_words_outside_the_head_are_placed_by_their_neighbours(two_kinds):
    assert tail_gain(two_kinds) > 0  # it was -0.27 with classes by hash bucket


@pytest.mark.parametrize("tokens", [1, 3, 10, 100])
def test_slices_of_a_piece_hold_every_text_once(tokens, monkeypatch):
    monkeypatch.setattr(B, "SLICE_TOKENS", tokens)
    rng = np.random.default_rng(tokens)
    piece = B.Piece.__new__(B.Piece)
    piece.end = 99
    for n in (0, 1, 5, 40):
        piece.sizes, piece.held = rng.integers(0, 6, n), rng.random(n) < 0.3
        piece.codes = rng.integers(0, 9, piece.sizes.sum()).astype(np.int32)
        texts = np.split(piece.codes, np.cumsum(piece.sizes)[:-1]) if n else []
        for training in (True, False):
            kept = [t for t, held in zip(texts, piece.held, strict=True) if not (held and training)]
            got = list(piece.tokens(training))
            assert [x for code, _ in got for x in code.tolist()] == [x for t in kept for x in [*t.tolist(), 99]]
            assert [x for _, size in got for x in size.tolist()] == [len(t) + 1 for t in kept]
