"""Hashed word n-grams of many texts at once, with numpy.

A word is a run of letters (any byte from 128 up counts as one), of digits, or
of other printable characters; white space separates.  Letters A-Z are folded.
Every word gets a 64-bit hash from prefix sums of a polynomial over the bytes,
so no Python code runs per word; n-grams combine neighbouring hashes and never
cross a text's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text hashed at a time (a longer text is one step by itself).
STEP_BYTES = 1 << 20

_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32, 0]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[128:] = 1
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
_FOLD += 1

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n + 1, STEP_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of its text) for texts laid end to
    end in ``data`` (bytes as uint8); text i ends before position ``ends[i]``."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = _CLASS[data]
    change = np.empty(len(data), bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    cuts = ends[ends < len(data)]
    change[cuts] = True
    begins = np.flatnonzero(change)
    stops = np.append(begins[1:], len(data))
    words = kind[begins] > 0
    begins, stops = begins[words], stops[words]
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_FOLD[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[stops] - sums[begins]) * down[begins])
    return hashes, np.searchsorted(ends, begins, "right")


def grams(hashes: np.ndarray, text: np.ndarray, gaps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of single words and, for each gap g, of the pairs (word i, word
    i + g) of one text; gap 1 is the bigram, larger gaps are skip-grams."""
    out, owner = [hashes], [text]
    for g in gaps:
        if len(hashes) > g:
            same = text[g:] == text[:-g]
            pair = mix(hashes[:-g] * np.uint64(0xD6E8FEB86659FD93) + hashes[g:] + np.uint64(g))
            out.append(pair[same])
            owner.append(text[g:][same])
            twice = text[g:][same & (hashes[g:] == hashes[:-g])]
            out.append(np.full(len(twice), mix(np.array([g], np.uint64))[0]))
            owner.append(twice)
    return np.concatenate(out), np.concatenate(owner)


def steps(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a binary Arrow column into bounded steps: (first row, rows, bytes, ends).  Null texts are empty."""
    column = column.cast(pa.binary())  # offsets of 32 bits, whatever the session's Arrow types
    sizes = np.array(column.is_valid()).astype(np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset) if len(column) else np.zeros(1, np.int32)
    sizes *= np.diff(offsets)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    total = np.cumsum(sizes)
    while at < len(column):
        before = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + STEP_BYTES, "right")))
        if sizes[at:stop].sum() == offsets[stop] - offsets[at]:
            chunk = data[offsets[at] : offsets[stop]]
        else:  # a null slot may hold bytes
            chunk = np.concatenate([data[offsets[i] : offsets[i] + sizes[i]] for i in range(at, stop)])
        yield at, stop - at, chunk, np.cumsum(sizes[at:stop])
        at = stop
