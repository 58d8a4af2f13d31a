"""Words and word shingles of UTF-8 text as 64-bit hashes, with numpy over whole batches.

A word is a maximal run of characters other than space and the control characters 9 to 13; A-Z
count as a-z. The separators are single bytes in UTF-8, so no decoding is needed.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from tidemark.llm.common import mix

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD6E8FEB86659FD93
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size`` powers of the base, and of its inverse modulo 2**64."""
    return _powers(1 << max(18, size.bit_length()))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 2**64)
    made = []
    for x in (_BASE, inverse):
        p = np.full(size, np.uint64(x))
        p[0] = 1
        made.append(np.cumprod(p, dtype=np.uint64))
    return made[0], made[1]


def span_hashes(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, none of them empty.

    Eight bytes and their place in the span are mixed before they are added up, so no pattern of
    letters cancels out; spans of one length up to eight bytes never share a hash.
    """
    if not len(begin):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    loads = np.ndarray(len(flat) + 1, "<u8", padded, strides=(1,))
    length = end - begin
    groups = (length + 7) // 8
    first = np.cumsum(groups) - groups
    of = np.repeat(np.arange(len(begin)), groups)
    place = np.arange(len(of)) - first[of]
    at = begin[of] + 8 * place
    spare = (8 - np.minimum(end[of] - at, 8)).astype(np.uint64) * np.uint64(8)
    value = loads[at] & (np.uint64(2**64 - 1) >> spare)
    terms = mix(value + place.astype(np.uint64) * np.uint64(_BASE))
    return mix(np.add.reduceat(terms, first) + length.astype(np.uint64) * np.uint64(_STEP))


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and for each row where its words begin (and at the end, all end)."""
    rows = len(offsets) - 1
    size = len(flat)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    inside = ~_SEPARATOR[flat]
    cut = np.zeros(size + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:size]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:size]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = span_hashes(_LOWER[flat], begin, end)
    return hashes, np.searchsorted(begin, offsets).astype(np.int64)


def shingle_hashes(
    hashes: np.ndarray, first: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``width`` words, and the row of each; a row with fewer words has
    its whole sequence as one; a row without words has none."""
    counts = np.diff(first)
    row_of = np.repeat(np.arange(len(counts)), counts)
    step = np.uint64(_STEP)
    full = np.zeros(0, np.uint64)
    full_rows = np.zeros(0, np.int64)
    if len(hashes) >= width:
        total = np.zeros(len(hashes) - width + 1, np.uint64)
        for k in range(width):
            total = total * step + hashes[k : len(hashes) - width + 1 + k]
        whole = row_of[: len(total)] == row_of[width - 1 :]
        full, full_rows = mix(total[whole] + np.uint64(width)), row_of[: len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if not len(short):
        return full, full_rows
    one = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        there = counts[short] > k
        one[there] = one[there] * step + hashes[first[short[there]] + k]
    one = mix(one + counts[short].astype(np.uint64))
    rows = np.concatenate([full_rows, short])
    order = np.argsort(rows, kind="stable")
    return np.concatenate([full, one])[order], rows[order]
