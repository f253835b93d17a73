"""Fixtures of awkward documents: nulls everywhere, empty and very long texts, repeated rows, clashing column names."""

import random
import zlib

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like the operators' own outputs and helpers.
EXTRA = "slot string, shard string, size string, n string, sid string, key string, score string, taken string, h string, w string, row string, label string"
ENGLISH = "the of and to in that was his he it with is for as had you not be her on at by which have or from this him but all she they".split()
GERMAN = "der die und in den von zu das mit sich des auf nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um".split()


def fold(doc_id, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k


def tokens(text):
    return (text or "").encode().lower().split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "ing", "er", "est", "ly"]) for _ in range(n))


def make_rows(n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = "en" if i % 2 else "de"
        rows.append((i, sentence(rng, ENGLISH if i % 2 else GERMAN, rng.randint(6, 60)), lang, f"src{i % 4}", 10))
    base = sentence(rng, ENGLISH, 120)
    for i in range(n, n + 12):  # near copies, a word changed in each
        w = base.split()
        w[(i * 7) % len(w)] = f"changed{i}"
        rows.append((i, " ".join(w), "en", "src0", 10))
    rows += [(200, None, "en", "src1", None), (201, "", None, None, 0), (202, " \t\n ", "de", "src1", 3), (203, "one two", None, None, 7), (204, "One  TWO", "en", "src2", 8),
             (None, "no id here at all but words", "en", "src1", 4), (205, "12345 !!! ???", "en", "src3", 12), (206, sentence(rng, ENGLISH, 30_000), "en", "src2", 1)]
    rows += [rows[5], rows[5], (207, rows[7][1], "de", "src3", 5)]  # repeated rows, and a copy with another id
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return make_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, doc_rows):
    names = [c.split()[0] for c in EXTRA.split(", ")]
    return spark.createDataFrame([(*r, *[f"x{i}" for i in range(len(names))]) for r in doc_rows], f"{DOC}, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
