"""Conversation structure repair by integer-minimum dynamic programming (operator 12).

Every row of a conversation is kept, reroled or deleted and empty rows may be
inserted, at the least cost, so that the role initials read ``(s?(ua)+)?``. The
edits' initials are the audit; among cheapest audits the ASCII-least counts.
Both are one weight: an ordinary integer whose high digits carry the cost and
whose octal low digits, ``width`` of them, hold the audit letters from the
front, zeros after the last. Putting an edit before a suffix adds its cost,
moves the digits down by one and writes the letter on top, so the smaller
integer is always the cheaper, then the lesser audit, and a plain ``min`` over
the edges (row, state) -> (row or next row, state) decides everything.

No task sees a whole conversation at once. Rows are put in order by range
partitions, numbered, and cut into blocks of at most ``BLOCK`` rows. Per block the
cheapest costs from each of the four grammar states to each other (small
integers) are folded backwards over a conversation's blocks, which gives every
block the cost still to come at its end; with that, each block runs the weighted
DP by itself (two different audits of a block never are one the beginning of
the other, because every row gives a letter, so letters behind the block cannot
change the choice); a forward pass strings the chosen states together. The
passes over a conversation hold one block at a time. Only the digest of a
repaired conversation is read in sequence, as SHA-256 demands, as a stream.

Defined results: a null conv_id is a conversation of its own; a null turn comes
first; a null role or text is one space. Rows of one turn are ordered by role,
the first 64 characters of the text and a hash of it, so repeats are
adjacent. Role initials are the first characters as written (``U`` is not ``u``).
A conversation without rows has zeros and an empty audit; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved

BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS  # rows a block
HEAD = 64  # characters of role and text that order the rows of a turn
SPACES = " \t\n\x0b\x0c\r"
ROLES = "uas"
NAMES = ("user", "assistant")
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; what may follow, and where it leads.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("u", "u", "a", "u")
INSERTED = (2, 2, 3, 2)
LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
LETTER = {"D": 1, "I": 2, "K": 3, "R": 4}  # ASCII order
FAR = 1 << 50  # a cost that no audit reaches
TO_LETTERS = str.maketrans("1234", "DIKR")


def _edits(role: str, fault: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the ways to treat a row."""
    out = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        more = CUT if fault == TRUNCATED else 0
        if role in STEP[state]:
            out.append(("K", KEEP + more, STEP[state][role]))
        out.append(("R", REROLE + more, INSERTED[state]))
    return out


def _closing(state: int) -> int:
    """Rows to insert at the end of a conversation."""
    return (0, 2, 1, 0)[state]


def _cost_matrix(code: int) -> np.ndarray:
    """Least costs from state to state over one row and the inserts before it."""
    role, fault = "uas-"[code >> 2], code & 3
    out = np.full((4, 4), FAR)
    for state in range(4):
        at, paid = state, 0
        for _ in range(3):  # at most two inserts lead to every state that inserts can lead to
            for _, cost, to in _edits(role, fault, at):
                out[state, to] = min(out[state, to], paid + cost)
            at, paid = INSERTED[at], paid + INSERT
    return out


COSTS = np.stack([_cost_matrix(code) for code in range(16)])
EDITS = [[_edits("uas-"[code >> 2], code & 3, state) for state in range(4)] for code in range(16)]


@lru_cache(maxsize=1 << 14)
def block_costs(codes: bytes) -> tuple[int, ...]:
    """Least costs over a block, state to state (16 numbers): min-plus products taken pairwise."""
    m = COSTS[np.frombuffer(codes, np.uint8)]
    while len(m) > 1:
        odd = m[len(m) & ~1:]
        m = np.concatenate([(m[0:len(m) & ~1:2, :, :, None] + m[1::2, None, :, :]).min(axis=2), odd])
    return tuple(np.minimum(m[0], FAR).ravel().tolist())


@lru_cache(maxsize=1 << 14)
def block_audits(codes: bytes, ends: tuple[int, ...], last: bool) -> tuple[tuple[str, int], ...]:
    """The best (audit, state after it) of a block from each state, given the costs behind it."""
    width = 2 * len(codes) + 4
    bits = 3 * width
    digits = (1 << bits) - 1

    def put(letter: str, cost: int, rest: int) -> int:
        low = rest & digits
        return rest - low + (cost << bits) + (LETTER[letter] << (bits - 3)) + (low >> 3)

    value = []
    for state in range(4):
        weight = ends[state] << bits
        if last:
            weight = 0
            for _ in range(_closing(state)):
                weight = put("I", INSERT, weight)
        value.append(weight)
    for code in reversed(codes):
        row = [min(put(letter, cost, value[to]) for letter, cost, to in EDITS[code][state]) for state in range(4)]
        value = [0, 0, min(row[2], put("I", INSERT, row[3])), min(row[3], put("I", INSERT, row[2]))]
        value[0], value[1] = (min(row[s], put("I", INSERT, value[2])) for s in (0, 1))
    found = []
    for state in range(4):
        audit = oct(value[state] & digits)[2:].rjust(width, "0").rstrip("0").translate(TO_LETTERS)
        at, rows = state, iter(codes)
        for letter in audit:
            code = None if letter == "I" else next(rows)
            if letter == "K":
                at = STEP[at]["uas-"[code >> 2]]
            elif letter != "D":
                at = INSERTED[at]
        found.append((audit, at))
    return tuple(found)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with every twentieth of them dropped, emptied, unpunctuated, repeated or reroled."""
    def written(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", written("role").alias("role"), written("text").alias("text"), kind.alias("kind")).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and pos, a number that rises in order over all rows; written as a table.

    The last key splits even one row repeated without end over partitions.
    """
    keys = ["conv_id", "turn", F.left("role", F.lit(HEAD)), F.left("text", F.lit(HEAD)), F.xxhash64("role", "text"), "at"]
    ranged = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return saved(ranged.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "repair-rows")


def blocks_of(rows: DataFrame) -> DataFrame:
    """conv_id, blk and codes (role and first fault of each row, in order; at most BLOCK) from rows in order."""
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(3)
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    marked = saved(rows.select("conv_id", "pos", role.alias("role"), fault.alias("fault"), F.unhex(same).alias("same")), "repair-marks")
    firsts = marked.groupBy("conv_id", "same").agg(F.min("pos").alias("first")).select("first")
    seen = marked.join(firsts, marked["pos"] == firsts["first"], "left")
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    coded = seen.select("conv_id", "pos", (4 * F.col("role") + fault).cast("tinyint").alias("code"))
    listed = F.array_sort(F.collect_list(F.struct("pos", "code")))
    return coded.groupBy("conv_id", F.shiftright("pos", BLOCK_BITS).alias("blk")).agg(F.transform(listed, lambda x: x["code"]).alias("codes"))


def _code_rows(column) -> list[bytes]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()
    at = column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(at, at[1:])]


def _backward(batches: Iterator) -> Iterator:
    """Blocks of a conversation, last first: the costs behind each block and the least cost from its start."""
    import pyarrow as pa

    now, ends = object(), ()
    for batch in batches:
        convs, out = batch.column(0).to_pylist(), []
        for conv, codes in zip(convs, _code_rows(batch.column(2))):
            last = conv != now
            if last:
                now, ends = conv, tuple(INSERT * _closing(s) for s in range(4))
            m = block_costs(codes)
            start = tuple(min(FAR, *(m[4 * s + to] + ends[to] for to in range(4))) for s in range(4))
            out.append((list(ends), last, start[0]))
            ends = start
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 3, (pa.list_(pa.int64()), pa.bool_(), pa.int64())))],
                                         names=["conv_id", "blk", "codes", "ends", "last", "cost"])


def _audits(batches: Iterator) -> Iterator:
    """Each block by itself: its best audit from every state, the state after it, and its fault counts."""
    import pyarrow as pa

    for batch in batches:
        out = []
        ends, last = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for codes, e, z in zip(_code_rows(batch.column(2)), ends, last):
            found = block_audits(codes, tuple(e), z)
            initials = "".join("uas-"[c >> 2] for c in codes)
            faults = [sum(c & 3 == f for c in codes) for f in (BLANK, DUPLICATE, TRUNCATED)]
            illegal = sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))
            out.append(([a for a, _ in found], [s for _, s in found], *faults, illegal, initials[0], initials[-1]))
        kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.int64()] * 4, pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)), batch.column(5)],
                                         names=["conv_id", "blk", "audits", "states", "blank", "duplicate", "truncated", "illegal", "head", "tail", "cost"])


def _forward(batches: Iterator) -> Iterator:
    """Blocks of a conversation in order: the state each begins with chooses its audit; pairs of roles across blocks are judged."""
    import pyarrow as pa

    now, state, tail = object(), 0, ""
    for batch in batches:
        rows = batch.to_pylist()
        chosen, begins, illegal, cost = [], [], [], []
        for r in rows:
            first = r["conv_id"] != now
            if first:
                now, state = r["conv_id"], 0
            chosen.append(r["audits"][state])
            begins.append(state)
            illegal.append(r["illegal"] + (not first and tail + r["head"] not in LEGAL))
            cost.append(r["cost"] if first else 0)
            state, tail = r["states"][state], r["tail"]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(chosen, pa.string()), pa.array(begins, pa.int32()), *batch.columns[4:7],
                                          pa.array(illegal, pa.int64()), pa.array(cost, pa.int64())],
                                         names=["conv_id", "blk", "audit", "state", "blank", "duplicate", "truncated", "illegal", "cost"])


def plan_edits(rows: DataFrame) -> DataFrame:
    """conv_id, blk, audit, state (before the block), blank, duplicate, truncated, illegal and cost, a row per block."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    name = f"conv_id {kind}, blk long"
    behind = blocks_of(rows).repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.desc("blk")).mapInArrow(
        _backward, f"{name}, codes array<tinyint>, ends array<long>, last boolean, cost long")
    counts = "blank long, duplicate long, truncated long, illegal long"
    audits = behind.repartition("conv_id", "blk").mapInArrow(_audits, f"{name}, audits array<string>, states array<int>, {counts}, head string, tail string, cost long")
    return saved(audits.repartition("conv_id").sortWithinPartitions("conv_id", "blk").mapInArrow(_forward, f"{name}, audit string, state int, {counts}, cost long"), "repair-edits")


class _Scribe:
    """Applies a block's audit to its rows as they come; gives (role, text, edit) of the repaired rows."""

    def start(self, audit: str, state: int) -> None:
        self.letters, self.at, self.state = audit, 0, state

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            yield NAMES[WANTED[self.state] == "a"], "", "I"
            self.state = INSERTED[self.state]
            self.at += 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserts()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "R":
            yield NAMES[WANTED[self.state] == "a"], text, "R"
            self.state = INSERTED[self.state]
        elif letter == "K":
            yield role, text, "K"
            self.state = STEP[self.state][role[:1]]


def _repaired(batches: Iterator) -> Iterator[tuple]:
    """(conv_id, blk, role, text, edit) of the repaired rows from audits and rows sorted together; role None begins a block."""
    scribe, where = _Scribe(), None
    for batch in batches:
        for conv, blk, audit, state, role, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "blk", "audit", "state", "role", "text"))):
            if audit is not None:
                if where:
                    yield from ((*where, *x) for x in scribe.inserts())
                where = conv, blk
                scribe.start(audit, state)
                yield conv, blk, None, None, None
            else:
                yield from ((conv, blk, *x) for x in scribe.row(role, text))
    if where:
        yield from ((*where, *x) for x in scribe.inserts())


def _with_audits(rows: DataFrame, edits: DataFrame, *by: str) -> DataFrame:
    marks = edits.select("conv_id", "blk", F.lit(-1).cast("long").alias("pos"), "audit", "state", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    plain = rows.select("conv_id", F.shiftright("pos", BLOCK_BITS).alias("blk"), "pos", F.lit(None).cast("string").alias("audit"), F.lit(None).cast("int").alias("state"), "role", "text")
    return marks.unionByName(plain).repartition(*by).sortWithinPartitions("conv_id", "blk", "pos")


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, blk, place (order within the block), role, text and edit (K, R or I) of every row of the repaired conversations."""
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out, place, size = [], 0, 0
        for conv, blk, role, text, edit in _repaired(batches):
            if role is None:
                place = 0
                continue
            out.append((conv, blk, place, role, text, edit))
            place, size = place + 1, size + len(text)
            if len(out) >= 4096 or size > 1 << 22:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=shape)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=shape)

    from pyspark.sql.pandas.types import to_arrow_type
    import pyarrow as pa

    names = ["conv_id", "blk", "place", "role", "text", "edit"]
    kind = rows.schema["conv_id"].dataType
    shape = pa.schema([("conv_id", to_arrow_type(kind)), ("blk", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    return _with_audits(rows, edits, "conv_id", "blk").mapInArrow(write, f"conv_id {kind.simpleString()}, blk long, place long, role string, text string, edit string")


def digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of the repaired ``role:text`` lines, read as a stream in order."""
    def digest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out, now, sha, begun = [], object(), None, False
        for conv, _, role, text, _ in _repaired(batches):
            if conv != now:
                if sha:
                    out.append((now, sha.hexdigest()))
                now, sha, begun = conv, hashlib.sha256(), False
                if len(out) >= 4096:
                    yield batch_of(pa, out)
                    out = []
            if role is not None:
                sha.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        if sha:
            out.append((now, sha.hexdigest()))
        yield batch_of(pa, out)

    def batch_of(pa, out):
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], arrow), pa.array([s for _, s in out], pa.string())], names=["conv_id", "repaired_sha256"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    return _with_audits(rows, edits, "conv_id").mapInArrow(digest, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows in order with ``pos``, edits per block) of ``conversations`` as they are; see ``repaired_rows`` and ``report``."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = in_order(conversations.select("conv_id", "turn", *spaced))
    return rows, plan_edits(rows)


def report(ids: DataFrame, rows: DataFrame, edits: DataFrame) -> DataFrame:
    """One row for every conv_id of ``ids``: gaps, faults, illegal pairs, cost, audit and the digest of the repaired text."""
    turns = rows.filter("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long").alias("gaps"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("blk", "audit"))), lambda x: x["audit"]), "")
    sums = edits.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], whole.alias("audit"))
    out = ids.select(F.col("conv_id").alias("asked")).distinct()
    for part in (gaps, sums, digests(rows, edits)):
        out = out.join(part, F.col("asked").eqNullSafe(part["conv_id"]), "left").drop("conv_id")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("asked").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damages ``conversations``, repairs what is left, and reports every original conversation."""
    return report(conversations, *repair(damage(conversations)))
