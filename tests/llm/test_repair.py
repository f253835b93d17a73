"""Conversation repair: all edits by plain (cost, audit) pairs, blocks of any size, awkward rows, SQL on the awkward rows."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from quarry.llm import repair, sql
from quarry.llm.repair import block_audits, damage, in_order, plan_edits, repair_damaged, repaired_rows
from tests.helpers import assert_same

ROW = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def broken(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """All states forwards, each with the least (cost, audit): plain strings, positions counted by rows and inserts."""
    step = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    best = {}

    def suffix(i, state, inserts):
        if inserts > 2:
            return (10**9, "")
        key = i, state, inserts
        if key not in best:
            ways = [(0, "")] if i == len(rows) and state in (0, 3) else []
            (role, to), = [(r, t) for r, t in step[state].items() if r != "s"]
            c, a = suffix(i, to, inserts + 1)
            ways.append((c + 2, "I" + a))
            if i < len(rows):
                c, a = suffix(i + 1, state, 0)
                ways.append((c + 3, "D" + a))
                if found[i] not in ("blank", "duplicate"):
                    more = found[i] == "truncated"
                    c, a = suffix(i + 1, to, 0)
                    ways.append((c + 2 + more, "R" + a))
                    if rows[i][2][:1] in step[state]:
                        c, a = suffix(i + 1, step[state][rows[i][2][:1]], 0)
                        ways.append((c + more, "K" + a))
            best[key] = min(ways)
        return best[key]

    cost, audit = suffix(0, 0, 0)
    lines, at, i = [], 0, 0
    for letter in audit:
        if letter == "I":
            lines.append(("assistant" if at == 2 else "user", ""))
            at = 3 if at == 2 else 2
            continue
        if letter == "K":
            lines.append(rows[i][2:])
            at = step[at][rows[i][2][:1]]
        if letter == "R":
            lines.append(("assistant" if at == 2 else "user", rows[i][3]))
            at = 3 if at == 2 else 2
        i += 1
    return cost, audit, lines


def expected(rows):
    out = []
    after = broken(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found = faults(mine)
        cost, audit, lines = cheapest(mine, found)
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def talk(rng, conv, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", "understudy"]
    texts = ["Yes.", "No!", "and then", "What?", " \t", "Ok. ", "é…", "x" * rng.randrange(1, 90) + ".", "same same.\n"]
    return [(conv, t if rng.random() < 0.9 else rng.randrange(n), rng.choice(roles[:5] if rng.random() < 0.8 else roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.random()}.") for t in range(n)]


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    rows = [r for conv in range(70) for r in talk(rng, conv, rng.randint(1, 14))]
    rows += talk(rng, 500, 260)  # long, over many blocks
    rows += [(600, 3, "user", "Hi.")] * 40  # one row over and over
    rows += [(None, 1, "user", "Hello."), (None, None, "assistant", "Hello."), (None, 2, None, "x."), (601, None, None, None), (601, None, "user", "b."), (601, None, "assistant", "c."),
             (602, 1, "user", None), (603, -5, "user", "q?"), (603, 5, "assistant", "a." * 50_000), (604, 0, "system", "s.")]
    rows += [(700 + i, 0, "user", "Only row.") for i in range(60)]  # some lose all their rows
    return rows


@pytest.mark.parametrize("bits", [10, 2, 0])
def test_equals_plain_search_with_blocks_of_any_size(spark, talks, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in talks], f"{ROW}, blk string, pos string, audit string").repartition(5)
    got, want = answer(repair_damaged(df)), expected(talks)
    assert got == want
    assert any(r[7] == "" for r in got) and all(any(c in r[7] for r in got) for c in "DIKR")


def test_sql_agrees_on_awkward_rows(spark, talks):
    import pandas as pd

    con = duckdb.connect()
    frame = pd.DataFrame([r for r in talks if r[0] != 500], columns=["conv_id", "turn", "role", "text"])
    con.register("given", frame)
    con.execute("CREATE VIEW conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM given")
    df = spark.createDataFrame([r for r in talks if r[0] != 500], ROW)
    assert_same(repair_damaged(df).toPandas(), con.sql(sql.conversations()).df())


def test_ties_take_the_least_audit_and_long_blocks_agree():
    rng = random.Random(2)
    for n in (1, 2, 3, 5, 9, 40):
        for _ in range(40):
            codes = bytes(rng.choice([0, 4, 8, 12, 1, 2, 3, 5, 7, 11]) for _ in range(n))
            rows = [(0, 0, {0: "u", 1: "a", 2: "s", 3: "x"}[c >> 2], "") for c in codes]
            found = [["", "blank", "duplicate", "truncated"][c & 3] for c in codes]
            cost, audit, _ = cheapest(rows, found)
            ends = (0, 4, 2, 0)
            assert block_audits(codes, ends, True)[0][0] == audit
            m = repair.block_costs(codes)
            assert min(m[to] + ends[to] for to in range(4)) == cost


def test_repaired_rows_follow_the_grammar(spark, talks, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 3)
    rows = in_order(damage(spark.createDataFrame(talks, ROW)))
    edits = plan_edits(rows)
    got = {}
    for r in repaired_rows(rows, edits).collect():
        got.setdefault(r["conv_id"], []).append(((r["blk"], r["place"]), r["role"], r["text"], r["edit"]))
    want = {r[0]: r for r in expected(talks)}
    for conv, lines in got.items():
        lines.sort()
        assert re.fullmatch("(s?(ua)+)?", "".join(x[1][0] for x in lines))
        assert hashlib.sha256("\n".join(f"{x[1]}:{x[2]}" for x in lines).encode()).hexdigest() == want[conv][8]
        assert "".join(x[3] for x in lines) == want[conv][7].replace("D", "")
    assert len(got) > 70


def test_empty_table(spark):
    assert answer(repair_damaged(spark.createDataFrame([], ROW))) == []
