"""Vectorised tokenising of Arrow text columns, shared by the operators that run numpy inside tasks.

Texts are read straight from the Arrow value buffer, in slices of about ``SLICE_BYTES`` (a longer text is
a slice of its own), so memory does not depend on the batch size. A word's hash is a polynomial over a
random byte table modulo 2**64, finalised; equal words have equal hashes everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_R = _U(0x9E3779B97F4A7C15)
_RINV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply) of a uint64 array."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _R)

#: Lower-cased bytes, and which of them belong to words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IS_SPACED = np.ones(256, dtype=bool)
IS_SPACED[[0x20, *range(0x09, 0x0E)]] = False
IS_ALNUM = np.ones(256, dtype=bool)  # after lower-casing; bytes from 0x80 up belong to multi-byte code points
IS_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False

_powers = np.ones(1, dtype=_U)
_inverses = np.ones(1, dtype=_U)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 4096)
        grown = []
        for factor in (_R, _RINV):
            table = np.full(size, factor, dtype=_U)
            table[0] = 1
            grown.append(np.multiply.accumulate(table))
        if size > 4 * SLICE_BYTES:  # of one very long text: not kept
            return grown[0], grown[1]
        _powers, _inverses = grown
    return _powers, _inverses


def text_slices(column: pa.Array, limit: int = SLICE_BYTES,
                max_rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets within the bytes) of each slice. Nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    rows = len(column)
    if not rows:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + rows + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + limit, side="right")) - 1)
        last = min(last, first + max_rows)
        yield first, last, raw[offs[first]:offs[last]], offs[first:last + 1] - offs[first]
        first = last


class Words(NamedTuple):
    start: np.ndarray   # first byte of each word
    end: np.ndarray     # byte after its last
    hash: np.ndarray    # uint64
    count: np.ndarray   # words of each row
    first: np.ndarray   # index of each row's first word


def words_of(raw: np.ndarray, offs: np.ndarray, is_word: np.ndarray, seed: int = 0) -> Words:
    """The maximal runs of word bytes of each row, A-Z lower-cased, in order."""
    n = len(raw)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = is_word[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    powers, inverses = _power_tables(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(_BYTE_VALUES[LOWER[raw]] * powers[:n], out=total[1:])
    hashed = mix((total[end] - total[start]) * inverses[start] + (end - start).astype(_U) + _U(seed))
    first = np.searchsorted(start, offs)
    return Words(start, end, hashed, np.diff(first), first[:-1])


def sequence_hashes(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch of hashes from ``start`` to before ``end``."""
    powers, inverses = _power_tables(len(items) + 1)
    total = np.zeros(len(items) + 1, dtype=_U)
    np.cumsum(items * powers[:len(items)], out=total[1:])
    return mix((total[end] - total[start]) * inverses[start] + (end - start).astype(_U))


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes laid end to end: each item's group and its place within it."""
    group = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
    return group, place


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted by row and hash. A row of fewer words than
    ``size`` has its whole sequence as one shingle; a row without words has none."""
    count = np.where(words.count >= size, words.count - size + 1, (words.count > 0).astype(words.count.dtype))
    row, place = spread(count)
    at = words.first[row] + place
    length = np.minimum(words.count[row], size)
    hashed = np.zeros(len(row), dtype=_U)
    padded = np.concatenate([words.hash, np.zeros(size, dtype=_U)])
    short = bool((length < size).any())
    for j in range(size):
        step = hashed * _R + padded[at + j] + _U(j + 1)
        hashed = np.where(length > j, step, hashed) if short else step
    hashed = mix(hashed)
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    keep = np.ones(len(row), dtype=bool)
    keep[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    return row[keep], hashed[keep]
