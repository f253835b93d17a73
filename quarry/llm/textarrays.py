"""Whole texts as numpy arrays: word hashes without a Python object per word.

Used inside ``mapInArrow`` tasks. Texts are handled in pieces of about one
megabyte, cut at white space, so memory stays bounded for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random odd-ish 64-bit value per byte; A-Z share the values of a-z, white space is 0.
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_power = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        with np.errstate(over="ignore"):
            _power = np.concatenate([np.ones(1, np.uint64), np.full(max(n, 64) * 2, _BASE, np.uint64).cumprod(dtype=np.uint64)])
    return _power


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply), bijective."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def word_hashes(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (A-Z lower-cased) and byte offsets of the words of one buffer."""
    b = np.frombuffer(buf, np.uint8)
    space = _SPACE[b]
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    size = np.diff(starts, append=len(b))
    place = np.arange(starts[0], len(b)) - np.repeat(starts, size)
    with np.errstate(over="ignore"):
        value = _BYTE[b[starts[0]:]] * powers(int(size.max()) + 1)[place]
        return mix(np.add.reduceat(value, starts - starts[0])), starts


def pieces(texts: list) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Buffers of about PIECE bytes with the documents in them.

    Yields (buffer, document numbers, their byte offsets). A longer text is
    cut at white space and continues in the next buffer.
    """
    part: list[bytes] = []
    docs: list[int] = []
    offs: list[int] = []
    at = 0
    for i, t in enumerate(texts):
        t = t or b""
        lo = 0
        while True:
            hi = len(t)
            if hi - lo > PIECE:
                hi = lo + PIECE
                while hi < len(t) and not _SPACE[t[hi]]:
                    hi += 1
            piece = t[lo:hi] if lo or hi < len(t) else t
            docs.append(i)
            offs.append(at)
            part.append(piece)
            at += len(piece) + 1
            if at >= PIECE:
                yield b" ".join(part) + b" ", np.array(docs), np.array(offs)
                part, docs, offs, at = [], [], [], 0
            lo = hi
            if lo >= len(t):
                break
    if part:
        yield b" ".join(part) + b" ", np.array(docs), np.array(offs)


def doc_words(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts one after another, words per text)."""
    found, count = [], np.zeros(len(texts), np.int64)
    for buf, docs, offs in pieces(texts):
        h, starts = word_hashes(buf)
        found.append(h)
        where = np.searchsorted(offs, starts, "right") - 1
        count += np.bincount(docs[where], minlength=len(texts)) if len(starts) else 0
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), count


def groups_of(texts: list, limit: int = 4 * PIECE) -> Iterator[slice]:
    """Slices of consecutive texts with about ``limit`` bytes each (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= limit:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))
