"""Class-based n-gram language model, Brown style (operator 1).

Exchange clustering assigns every word with LEAST or more occurrences to one of
CLASSES classes; rarer and unseen words share one unit, which has a class too.
A word moves to the class that gains most likelihood of the class bigrams. A
sweep counts, over the whole training corpus, the class bigrams and the
neighbours by class of the HEAD most frequent words (a fixed size, summed by
Spark), which are moved one after another. Every other word is moved in each
sweep but the first, by itself, against the class bigrams of the sweep: a piece
of the corpus sends one message for each of its words, with the word's
neighbours by class (at most CELLS numbers); one shuffle brings the messages
together in blocks of words, a task adds them as they pass, moves the words, and
answers the pieces that asked. After the first two sweeps half of the
words move at a time; the assignment with the best exact likelihood is kept.

The model: ``P(w | v) = P(class(w) | class(v)) * P(w | class(w))``. Transitions
are smoothed towards the class unigram (Dirichlet, PRIOR); emissions discount
the count of each word too rare for a class of its own by DISCOUNT and give the
mass to the unknown words. The text ends with one end token, which is a class
of its own and also the context of the first word.

Scale: word counts are one aggregate over the corpus, written as a table. The
counts of the most frequent words (at most AT_HAND of them, found by a
threshold) travel to the tasks as arrays. The texts are written once, as pieces
of about PIECE_TOKENS tokens: a token is the number of a word at hand or of one
of the piece's own words, whose counts are joined once for each piece that has
them. Pieces and the tables that answer them are bucketed by piece, so that a
sweep does not shuffle the texts. AT_HAND only says by which way a word's class
reaches the texts; it changes no result (tested). Words are 64-bit hashes.

Defined results: null text is empty and has only its end token; without
training rows N and V are 0 and all scores are those of unknown words; repeated
rows and ids are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Table, batches_of, bucketed, fold
from quarry.llm.textarrays import doc_words, groups_of
from quarry.session import remove_path, written

CLASSES = 32
HEAD = 4096
#: Occurrences from which a word is assigned to a class by its own neighbours.
LEAST = 5
#: At least HEAD and CLASSES.
AT_HAND = 1 << 18
SWEEPS = 6
PRIOR = 20.0
DISCOUNT = 0.6
#: Distinct words a counting task holds before it passes their counts on.
HELD_WORDS = 1 << 20
#: Tokens from which a piece ends (a longer text is a piece of its own).
PIECE_TOKENS = 1 << 20
#: Bytes of an Arrow batch while the model is learned: a piece or two.
BATCH_BYTES = 4 << 20
#: Tokens a task has in full arrays at a time (or those of a longer text).
SLICE_TOKENS = 1 << 18
#: A word's neighbours: of each class before it, of each class after it, and the word itself before it.
SIDE = CLASSES + 1
CELLS = 2 * SIDE + 1
#: Counts of neighbours whose terms are computed once for all words.
SMALL = 64
#: Words in a block of messages, about, and messages that a task adds up at a time.
BLOCK_WORDS = 1024
MESSAGES = 1 << 14
#: Groups in which classes of words at hand are brought together.
GROUPS = 1024
#: Bits of a count beside a word's number.
COUNT_BITS = 40


def _tally(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(words, return_inverse=True)
    return distinct, np.bincount(where, counts, len(distinct)).astype(np.int64)


def count_words(batches: Iterator) -> Iterator:
    import pyarrow as pa

    def out(words, counts):
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["h", "n"])

    held, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for part in groups_of(texts):
            words, n = _tally(h := doc_words(texts[part])[0], np.ones(len(h), np.int64))
            held, counts = _tally(np.concatenate([held, words]), np.concatenate([counts, n]))
            if len(held) > HELD_WORDS:
                yield out(held, counts)
                held, counts = held[:0], counts[:0]
    yield out(held, counts)


class Vocabulary:
    """Words at hand in order of falling count: a word's place is its code. The end token's code is ``end``, a piece's own words follow."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        self.words, self.counts, self.end = hashes, counts, len(hashes)
        self.placed = int((counts >= LEAST).sum())
        self._order = np.argsort(hashes)
        self._sorted = hashes[self._order]

    def codes(self, h: np.ndarray) -> np.ndarray:
        """-1: not at hand."""
        if not self.end:
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self._sorted, h), self.end - 1)
        return np.where(self._sorted[at] == h, self._order[at], -1)


def frequent(counts: DataFrame, most: int) -> Vocabulary:
    """The words whose count reaches a threshold that at most ``most`` words reach."""
    tiers = sorted(counts.groupBy(F.floor(F.log2("n") * 64).alias("tier")).count().collect(), reverse=True)  # a few thousand rows at most
    seen, least = 0, None
    for tier, n in tiers:
        if seen + n > most:
            break
        seen, least = seen + n, tier
    if least is None:
        return Vocabulary(np.empty(0, np.uint64), np.empty(0, np.int64))
    got = counts.filter(F.floor(F.log2("n") * 64) >= least).toArrow()
    h, n = got["h"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.lexsort((h, -n))
    return Vocabulary(h[order], n[order])


def _pack(codes: np.ndarray) -> bytes:
    """Three bytes each, four where a code needs them."""
    wide = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.ascontiguousarray(wide[:, :4 if wide[:, 3].any() else 3]).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).reshape(n, -1) if n else np.empty((0, 3), np.uint8)
    wide = np.zeros((n, 4), np.uint8)
    wide[:, :b.shape[1]] = b
    return wide.view("<u4").ravel().astype(np.int32)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per piece of a partition: its ids, whether they are held out, their numbers of words, the words' codes, and the piece's own words."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(held):
            row, ids, flags = (pa.concat_arrays([x[0].column(c) for x in held]) for c in range(3))
            code, h, size = (np.concatenate([x[c] for x in held]) for c in (1, 2, 3))
            rare, where = np.unique(h, return_inverse=True)
            code[code < 0] = where + vocabulary.end + 1
            whole = pa.array([0, len(size)], pa.int32())
            lists = [pa.ListArray.from_arrays(whole, x) for x in (ids, flags, pa.array(size.astype(np.int32)))]
            own = pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), pa.array(rare.view(np.int64)))
            return pa.RecordBatch.from_arrays([row.slice(0, 1), *lists, pa.array([_pack(code)], pa.binary()), pa.array([len(rare)], pa.int32()), own], names=["piece", "ids", "held", "sizes", "codes", "own", "rare"])

        held, tokens = [], 0
        for batch in batches:
            texts = batch.column(3).to_pylist()
            keys = batch.select([0, 1, 2])
            for part in groups_of(texts):
                h, size = doc_words(texts[part])
                code = vocabulary.codes(h).astype(np.int32)
                held.append((keys.slice(part.start, part.stop - part.start), code, h[code < 0], size))
                tokens += len(h)
                if tokens >= PIECE_TOKENS:
                    yield out(held)
                    held, tokens = [], 0
        if held:
            yield out(held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"piece bigint, ids array<{kind}>, held array<boolean>, sizes array<int>, codes binary, own int, rare array<bigint>")


def own_counts(pieces: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per piece: ``counts`` of its own words that have one (number and count in one long), and as ``moves`` the first class of those that are placed."""
    asked = pieces.select("piece", F.posexplode("rare").alias("slot", "h"))
    rest = counts.filter(F.col("n") <= int(vocabulary.counts.min())) if vocabulary.end else counts
    found = asked.join(rest, "h").select("piece", (F.shiftleft(F.col("slot").cast("long"), COUNT_BITS) + F.col("n")).alias("x")).groupBy("piece").agg(F.collect_list("x").alias("counts"))
    placed = F.filter("counts", lambda x: x.bitwiseAND(F.lit((1 << COUNT_BITS) - 1)) >= LEAST)
    return found.select("piece", "counts", F.transform(placed, lambda x: F.shiftleft(F.shiftright(x, COUNT_BITS), 8) + (CLASSES - 1)).alias("moves"))


class State(NamedTuple):
    """Classes by code of the words at hand, the end token and (last) the shared unit; and the tables, latest last, with the classes of the pieces' own words."""

    classes: np.ndarray
    moves: list[Table]


class Piece:
    """One row of a state's frame inside a task."""

    def __init__(self, batch, i: int, classes: np.ndarray, tables: int):
        def array(name):
            x = batch.column(name)[i].values
            return np.empty(0, np.int64) if x is None else x.to_numpy(zero_copy_only=False)

        self.array, self.end = array, len(classes) - 2
        self.id = batch.column("piece")[i].as_py()
        self.sizes = array("sizes").astype(np.int64)
        self.held = array("held").astype(bool)
        self.codes = _unpack(batch.column("codes")[i].as_py(), int(self.sizes.sum()))
        #: class of each own word, -1: the shared unit's
        self.own = np.full(batch.column("own")[i].as_py(), -1, np.int16)
        for t in range(tables):
            moves = array(f"moves_{t}")
            self.own[moves >> 8] = moves & 255
        self.by_code = np.concatenate([classes[:-1], np.where(self.own < 0, classes[-1], self.own)]).astype(np.uint8)

    def tokens(self, training: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of some texts at a time: codes with an end token after each text, and the number of tokens of each; of training texts or of all."""
        ends = np.cumsum(self.sizes)
        cuts = np.flatnonzero(np.diff(np.cumsum(self.sizes + 1) // SLICE_TOKENS, prepend=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(ends)], strict=True):
            size = self.sizes[lo:hi]
            code = self.codes[ends[lo] - size[0]:ends[hi - 1]] if hi > lo else self.codes[:0]
            if training:
                code, size = code[np.repeat(~self.held[lo:hi], size)], size[~self.held[lo:hi]]
            if len(size):
                yield np.insert(code, np.cumsum(size), self.end), size + 1


def _before(code: np.ndarray, size: np.ndarray, end: int) -> np.ndarray:
    before = np.roll(code, 1)  # each text's first context is an end token
    before[np.cumsum(size) - size] = end
    return before


def frame(pieces: DataFrame, state: State, *more: str) -> DataFrame:
    """The pieces with what a state says of their own words; nothing is shuffled where all is bucketed by piece."""
    out = pieces.select("piece", "sizes", "held", "codes", "own", *more)
    for t, moves in enumerate(state.moves):
        out = out.join(moves.rows.select("piece", F.col("moves").alias(f"moves_{t}")), "piece", "left")
    return out


def _pieces(batches: Iterator, classes: np.ndarray, tables: int) -> Iterator[Piece]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Piece(batch, i, classes, tables)


def neighbours(pieces: DataFrame, state: State, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Cells [unit, side, class] of the HEAD words and, last, the shared unit: how often a class stands before (0) or after (1) it, the last class counting the unit itself; and N[a, b]: class b after class a."""
    width, k, head = SIDE + 1, SIDE, HEAD
    cells = (head + 1) * 2 * width
    classes, tables = state.classes, len(state.moves)
    fixed = np.full(vocabulary.end + 1, -1)  # row by code
    fixed[:min(head, vocabulary.placed)] = np.arange(min(head, vocabulary.placed))
    fixed[vocabulary.placed:-1] = head

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(cells + k * k, np.int64)
        for piece in _pieces(batches, classes, tables):
            row_of = np.concatenate([fixed, np.where(piece.own < 0, head, -1)])
            for code, size in piece.tokens(True):
                cls, row = piece.by_code[code], row_of[code]
                cls_before, row_before = (_before(x, size, e) for x, e in ((cls, CLASSES), (row, -1)))
                total[cells:] += np.bincount(cls_before.astype(np.int64) * k + cls, minlength=k * k)
                same = row == row_before
                for side, (r, other) in enumerate(((row, cls_before), (row_before, cls))):
                    mine = np.flatnonzero(r >= 0)
                    cell = (r[mine] * 2 + side) * width + np.where(same[mine], k, other[mine])
                    total[:cells] += np.bincount(cell, minlength=cells)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["cell", "n"])

    got = frame(pieces, state).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # a fixed number of rows at most
    total = np.zeros(cells + k * k)
    total[got["cell"].to_numpy()] = got["n"].to_numpy()
    return total[:cells].reshape(head + 1, 2, width), total[cells:].reshape(k, k)


def _turn(h: np.ndarray, sweep: int) -> np.ndarray:
    """Which words outside the HEAD move in this sweep: all in sweep 1, then half."""
    return np.full(len(h), True) if sweep == 1 else (h.view(np.uint64) >> np.uint64(40)).astype(np.int64) + sweep & 1 == 0


def messages(pieces: DataFrame, state: State, vocabulary: Vocabulary, sweep: int, bits: int) -> DataFrame:
    """What a piece says of the words to move, one row per piece and block of words (those whose hashes begin with the same ``bits``), in arrays as bytes: hashes, the words' numbers in the piece (at hand: -1 - code), classes, and neighbours as pairs (cell, count)."""
    head, classes, tables = HEAD, state.classes, len(state.moves)
    moving = np.zeros(vocabulary.end + 1, bool)
    moving[head:vocabulary.placed] = _turn(vocabulary.words[head:vocabulary.placed], sweep)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for piece in _pieces(batches, classes, tables):
            rare = piece.array("rare").view(np.uint64)
            sent = np.concatenate([moving, (piece.own >= 0) & _turn(rare, sweep)])
            found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
            for code, size in piece.tokens(True):
                cls = piece.by_code[code]
                at = np.flatnonzero(sent[code])  # no end token is sent, so a next token is there
                mine = code[at].astype(np.int64) * CELLS
                before, cls_before = (_before(x, size, e)[at] for x, e in ((code, piece.end), (cls, CLASSES)))
                left = mine + np.where(before == code[at], 2 * SIDE, cls_before)
                other = code[at + 1] != code[at]  # a word after itself is counted once, from the right one
                right = (mine + SIDE + cls[at + 1])[other]
                found.append(np.unique(np.concatenate([left, right]), return_counts=True))
            key, n = _tally(*(np.concatenate(x) for x in zip(*found, strict=True)))
            parts = (n + 254) // 255
            last = np.cumsum(parts) - 1
            pair = np.full((int(parts.sum()), 2), 255, np.uint8)
            pair[:, 0] = np.repeat(key % CELLS, parts)
            pair[last, 1] = n - 255 * (parts - 1)
            # words at hand that occur, and all own words: a held-out text needs their classes too
            words = np.union1d(key // CELLS, np.flatnonzero(sent[piece.end + 1:]) + piece.end + 1)
            cut = np.searchsorted(np.repeat(key // CELLS, parts), np.append(words, words[-1:] + 1))
            own = words > piece.end
            slot = np.where(own, words - piece.end - 1, -1 - words)
            h = np.empty(len(words), np.uint64)
            h[own], h[~own] = rare[slot[own]], vocabulary.words[words[~own]]
            if not len(words):
                continue
            order = np.argsort(h)
            block = _block(h[order], bits)
            first = np.flatnonzero(np.diff(block, prepend=-1))
            pairs = np.diff(cut)[order]
            ends = np.cumsum(pairs)
            pair = pair[np.arange(len(pair)) + np.repeat(cut[:-1][order] - ends + pairs, pairs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[first]), pa.array(np.full(len(first), piece.id)), *(_cut(x, first) for x in (h[order], slot[order].astype(np.int32), piece.by_code[words][order], pairs.astype(np.int32))), _cut(pair, (ends - pairs)[first])],
                names=["block", "piece", "h", "slot", "class", "n_pairs", "pairs"])

    return frame(pieces, state, "rare").mapInArrow(run, "block bigint, piece bigint, h binary, slot binary, class binary, n_pairs binary, pairs binary")


def _block(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _cut(x: np.ndarray, first: np.ndarray):
    """The rows of ``x`` as bytes, cut before each of ``first``."""
    import pyarrow as pa

    offsets = np.append(first, len(x)) * (x.nbytes // max(len(x), 1))
    return pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


class Words(NamedTuple):
    """Neighbours of words in order of hash, with the messages that ask for their classes."""

    h: np.ndarray
    sums: np.ndarray
    cls: np.ndarray
    word: np.ndarray
    piece: np.ndarray
    slot: np.ndarray

    def part(self, words: slice) -> Words:
        lo, hi, _ = words.indices(len(self.h))
        rows = slice(*np.searchsorted(self.word, (lo, hi)))
        return Words(self.h[words], self.sums[words], self.cls[words], self.word[rows] - lo, self.piece[rows], self.slot[rows])

    def after(self, held: Words) -> Words:
        """With what is ``held`` of earlier messages."""
        h = np.union1d(held.h, self.h)
        sums, cls = np.zeros((len(h), CELLS)), np.empty(len(h), np.int64)
        at = [np.searchsorted(h, x.h) for x in (held, self)]
        for x, where in zip((held, self), at, strict=True):
            sums[where] += x.sums
            cls[where] = x.cls
        word = np.concatenate([where[x.word] for x, where in zip((held, self), at, strict=True)])
        return Words(h, sums, cls, word, np.concatenate([held.piece, self.piece]), np.concatenate([held.slot, self.slot])).in_order()

    def in_order(self) -> Words:
        """Messages in order of words; words at hand are asked for once."""
        order = np.argsort(self.word, kind="stable")
        word = self.word[order]
        keep = self.slot[order] >= 0
        keep[np.searchsorted(word, np.arange(len(self.h)))] = True
        order = order[keep]
        return self._replace(word=word[keep], piece=self.piece[order], slot=self.slot[order])


def _words(batch) -> Words:
    h, slot, cls, pairs, cells = (np.frombuffer(b"".join(batch.column(c).to_pylist()), kind) for c, kind in zip(range(2, 7), (np.uint64, np.int32, np.uint8, np.int32, np.uint8), strict=True))
    piece = np.repeat(batch.column(1).to_numpy(), [len(x) // 8 for x in batch.column(2).to_pylist()])
    words, first, word = np.unique(h, return_index=True, return_inverse=True)
    cells, of = cells.reshape(-1, 2), np.repeat(word, pairs)
    sums = np.bincount(of * CELLS + cells[:, 0], cells[:, 1], len(words) * CELLS).reshape(-1, CELLS)
    return Words(words, sums.astype(float), cls[first].astype(np.int64), word, piece, slot.astype(np.int64)).in_order()


def _parts(batches: Iterator) -> Iterator[Words]:
    """A few messages at a time."""
    for batch in batches:
        size = np.array([len(x) // 8 for x in batch.column(2).to_pylist()], np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // MESSAGES, prepend=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(size)], strict=True):
            if hi > lo:
                yield _words(batch.slice(lo, hi - lo))


def answers(sent: DataFrame, bigrams: np.ndarray, bits: int) -> DataFrame:
    """Per piece (below 0: words at hand) the ``moves``: number of the word and its new class."""
    added = added_terms(bigrams)

    def out(words: Words):
        import pyarrow as pa

        new = best_classes(words.sums, words.cls, bigrams, added)[words.word]
        at_hand = words.slot < 0
        slot = np.where(at_hand, -1 - words.slot, words.slot)
        piece = np.where(at_hand, -1 - slot % GROUPS, words.piece)
        order = np.argsort(piece, kind="stable")
        piece, move = piece[order], (slot << 8 | new)[order]
        first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])) if len(piece) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(piece[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(piece)).astype(np.int32)), pa.array(move))], names=["piece", "moves"])

    def run(batches: Iterator) -> Iterator:
        held = None
        for words in _parts(batches):
            if held is not None:
                words = words.after(held)
            block = _block(words.h, bits)
            last = int(np.searchsorted(block, block[-1]))  # the last block may go on
            yield out(words.part(slice(0, last)))
            held = words.part(slice(last, None))
        if held is not None:
            yield out(held)

    ordered = sent.repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(run, "piece bigint, moves array<bigint>").groupBy("piece").agg(F.flatten(F.collect_list("moves")).alias("moves"))


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _first(gain: np.ndarray) -> np.ndarray:
    """The best class, the first of those equal to six places."""
    return np.round(gain, 6).argmax(1)


def likelihood(bigrams: np.ndarray) -> float:
    return float(_f(bigrams).sum() - _f(bigrams.sum(0)).sum() - _f(bigrams.sum(1)).sum())


def move_units(cells: np.ndarray, bigrams: np.ndarray, classes: np.ndarray, sweep: int, placed: int) -> np.ndarray:
    """Exchange: each counted unit of this sweep's half goes to its best class, class bigrams kept up to date, neighbours as counted at its start. ``placed``: words at hand that have a class of their own."""
    classes, n = classes.copy(), bigrams.copy()
    weight = cells[:, 0].sum(1)
    for row in np.argsort(-weight, kind="stable"):
        u = int(row) if row < HEAD else len(classes) - 1
        if not weight[row] or (int(row) * 2654435761 >> 7) + sweep & 1 and sweep:
            continue
        left, right = cells[row, 0, :SIDE], cells[row, 1, :SIDE]
        itself, a = cells[row, 0, SIDE], classes[u]
        n[:, a] -= left
        n[a, :] -= right
        n[a, a] -= itself
        np.maximum(n, 0, out=n)
        b = int(_first(gains(n[None], left[None], right[None], np.array([itself])))[0])
        classes[u] = b
        n[:, b] += left
        n[b, :] += right
        n[b, b] += itself
    classes[placed:-2] = classes[-1]
    return classes


def gains(n: np.ndarray, left: np.ndarray, right: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """[word, class]: likelihood gained by words put into each class; ``n``: class bigrams without the word."""
    own = np.arange(CLASSES)
    f = _f(n)
    cols, rows = n[:, :, :CLASSES], n[:, :CLASSES]
    gain = (_f(cols + left[:, :, None]) - f[:, :, :CLASSES]).sum(1) + (_f(rows + right[:, None, :]) - f[:, :CLASSES]).sum(2)
    corner, l, r, i = n[:, own, own], left[:, :CLASSES], right[:, :CLASSES], itself[:, None]
    gain += _f(corner + l + r + i) - _f(corner + l) - _f(corner + r) + _f(corner)
    for total, add in ((n.sum(1)[:, :CLASSES], left), (n.sum(2)[:, :CLASSES], right)):
        gain -= _f(total + add.sum(1)[:, None] + i) - _f(total)
    return gain


def dense_gains(sums: np.ndarray, a: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """``gains`` of words with classes ``a`` in ``bigrams``, from a copy of the bigrams per word."""
    at, left, right, itself = np.arange(len(a)), sums[:, :SIDE], sums[:, SIDE:-1], sums[:, -1]
    n = np.repeat(bigrams[None], len(a), 0)
    n[at, :, a] -= left
    n[at, a, :] -= right
    n[at, a, a] -= itself
    return gains(n, left, right, itself)


def read_gains(sums: np.ndarray, a: np.ndarray, bigrams: np.ndarray, added: np.ndarray) -> np.ndarray:
    """The same for words with counts below SMALL: most terms are read from ``added`` (``added_terms``), as a word changes only the row and the column of its class."""
    at, left, right, itself = np.arange(len(a)), sums[:, :SIDE], sums[:, SIDE:-1], sums[:, -1]
    l, r, side = left[:, :CLASSES], right[:, :CLASSES], np.arange(SIDE)
    whole = sums.astype(np.intp)
    gain = added[0, whole[:, :SIDE], side].sum(1) + added[1, whole[:, SIDE:-1], side].sum(1)
    for own, other, x, table in ((bigrams[a, :CLASSES] - r, left[at, a], whole[at, a], added[0]), (bigrams.T[a, :CLASSES] - l, right[at, a], whole[at, SIDE + a], added[1])):
        gain += _f(own + other[:, None]) - _f(own) - table[x, a]
    col, row = bigrams.T[a] - left, bigrams[a] - right  # of the word's class, without it
    col[at, a] -= right[at, a] + itself
    row[at, a] -= left[at, a] + itself
    gain[at, a] = (_f(col + left) - _f(col)).sum(1) + (_f(row + right) - _f(row)).sum(1)
    corner = np.repeat(np.diag(bigrams)[None, :CLASSES], len(a), 0)
    corner[at, a] = col[at, a]
    i = itself[:, None]
    gain += _f(corner + l + r + i) - _f(corner + l) - _f(corner + r) + _f(corner)
    for total, add, mine in ((bigrams.sum(0)[:CLASSES] - r, left, col), (bigrams.sum(1)[:CLASSES] - l, right, row)):
        total[at, a] = mine.sum(1)
        gain -= _f(total + add.sum(1)[:, None] + i) - _f(total)
    return gain


def added_terms(bigrams: np.ndarray) -> np.ndarray:
    """[side, count, neighbour's class, class]: what so many neighbours add to one term of the likelihood."""
    n = np.stack([bigrams[:, :CLASSES], bigrams.T[:, :CLASSES]])[:, None]
    return _f(n + np.arange(SMALL)[:, None, None]) - _f(n)


def best_classes(sums: np.ndarray, cls: np.ndarray, bigrams: np.ndarray, added: np.ndarray) -> np.ndarray:
    """The best class of each word, moved alone; ``sums``: its neighbours, ``cls``: its class in ``bigrams``."""
    new = np.empty(len(cls), np.int64)
    small = (sums < SMALL).all(1)
    for mine, gains_of in ((np.flatnonzero(small), lambda *x: read_gains(*x, bigrams, added)), (np.flatnonzero(~small), lambda *x: dense_gains(*x, bigrams))):
        for lo in range(0, len(mine), 256):
            part = mine[lo:lo + 256]
            new[part] = _first(gains_of(sums[part], cls[part]))
    return new


def cluster(pieces: DataFrame, first: Table, vocabulary: Vocabulary, placed: int, buckets: int, sweeps: int = SWEEPS) -> tuple[State, np.ndarray, list[float]]:
    """(the best state, its class bigrams, likelihood after each sweep). The most frequent words start a class each, the rest shares the last. The HEAD moves first, the other ``placed`` words from the second sweep on. Tables that no kept state reads are deleted."""
    classes = np.full(vocabulary.end + 2, CLASSES - 1)
    classes[:CLASSES - 1][:vocabulary.placed] = np.arange(CLASSES - 1)[:vocabulary.placed]
    classes[vocabulary.end] = CLASSES
    state, best, path = State(classes, [first]), None, []
    bits = max(placed // BLOCK_WORDS, 1).bit_length() - 1
    for sweep in range(sweeps + 1):
        cells, bigrams = neighbours(pieces, state, vocabulary)
        path.append(likelihood(bigrams))
        if best is None or path[-1] > best[0]:
            best = path[-1], state, bigrams
        if sweep == sweeps:
            break
        moved, tables = move_units(cells, bigrams, state.classes, sweep, vocabulary.placed), state.moves
        if sweep and placed > min(HEAD, vocabulary.placed):
            got = bucketed(answers(messages(pieces, state, vocabulary, sweep, bits), bigrams, bits), "lm-moves", "piece", buckets)
            at_hand = got.rows.filter("piece < 0").select("moves").toArrow()["moves"].combine_chunks().flatten().to_numpy()  # at most AT_HAND words
            moved[at_hand >> 8] = at_hand & 255
            tables = [*tables, got][-2:]  # two halves, or all words and a half
        old, state = state, State(moved, tables)
        for table in old.moves:
            if not any(table is kept for s in (state, best[1]) for kept in (*s.moves, first)):
                table.delete()
    return best[1], best[2], path


class Model:
    """Class tables; ``rare`` is the number of training words that share a unit, ``shared`` its class."""

    def __init__(self, bigrams: np.ndarray, rare: int, shared: int):
        tokens = bigrams.sum(0)
        prior = (tokens + 1) / (tokens.sum() + len(tokens))
        self.step = np.log10((bigrams + PRIOR * prior) / (bigrams.sum(1, keepdims=True) + PRIOR))
        # what a class's words share: log10 of 1 / tokens, and of the mass of the unknown words
        tokens[shared] += 0 if rare else DISCOUNT
        self.share = -np.log10(np.maximum(tokens, 1))
        self.unknown = float(np.log10(DISCOUNT * max(rare, 1)))
        self.share[CLASSES] = 0.0  # the end token is its class's only word


def score(docs: DataFrame, sweeps: int = SWEEPS, at_hand: int = AT_HAND) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity for every document."""
    spark: SparkSession = docs.sparkSession
    learn = docs.filter(fold(F.col("doc_id"), 7) != 2)
    counts, counts_path = written(learn.select(F.coalesce(F.col("text"), F.lit("")).cast("binary")).mapInArrow(count_words, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")), "llm-lm-words")
    ends = learn.count()
    words, tokens, placed = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") >= LEAST)).first()
    n, v = tokens + ends, words + (ends > 0)
    vocabulary = frequent(counts, at_hand)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with batches_of(spark, BATCH_BYTES):
        pieces = bucketed(encode(docs, vocabulary), "lm-pieces", "piece", buckets).rows
        own = bucketed(own_counts(pieces, counts, vocabulary), "lm-counts", "piece", buckets)
        remove_path(spark, counts_path)
        state, bigrams, _ = cluster(pieces, own, vocabulary, placed, buckets, sweeps)

    classes, tables, spread = state.classes, len(state.moves), float(n + v + 1)
    model = Model(bigrams, words - placed, int(classes[-1]))
    known = np.append(vocabulary.counts, ends)  # by code

    def walk(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                piece = Piece(batch, i, classes, tables)
                packed = piece.array("counts")
                rare = np.zeros(len(piece.own), np.int64)
                rare[packed >> COUNT_BITS] = packed & (1 << COUNT_BITS) - 1
                count = np.concatenate([known, rare])
                base = np.log10((count + 1) / spread)
                emit = np.where(count > 0, np.log10(np.maximum(count - DISCOUNT * (count < LEAST), 1e-9)), model.unknown) + model.share[piece.by_code]
                emit[piece.end] = 0.0
                at = 0
                for code, size in piece.tokens(False):
                    cls = piece.by_code[code]
                    first = np.cumsum(size) - size
                    sums = [np.add.reduceat(x, first) for x in ((count > 0).astype(np.int64)[code], base[code], emit[code] + model.step[_before(cls, size, CLASSES), cls])]
                    keys = [batch.column(c)[i].values.slice(at, len(size)) for c in ("ids", "held")]
                    at += len(size)
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(size), *map(pa.array, sums)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = frame(pieces, state, "ids").join(own.rows.select("piece", "counts"), "piece", "left")
    out = out.mapInArrow(walk, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
