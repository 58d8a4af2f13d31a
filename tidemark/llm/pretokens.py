"""Byte-level pre-tokens of UTF-8 text with numpy, and a table from their hashes to ids.

The cut is that of the byte-level pattern: contractions; runs of letters, of numbers or of other
characters, each with one space before it if there is one; white space otherwise. It is found for a
whole batch at once from the class of every byte: no string is made for a word.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

from tidemark.llm.words import span_hashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Endings that follow an apostrophe in the byte-level pattern (fixed values).
SHORT_ENDINGS, LONG_ENDINGS = b"stmd", (b"re", b"ve", b"ll")


@cache
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    everything = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(0x110000))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, everything):
            table[found.start() : found.end()] = kind
    return table


def byte_classes(flat: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    table = class_table()
    low = np.zeros(256, np.uint8)
    low[:128] = table[:128]
    made = low[flat]
    lead = np.flatnonzero(flat >= 0xC0)
    if not len(lead):
        return made
    top = len(flat) - 1
    first = flat[lead].astype(np.int64)
    tail = [flat[np.minimum(lead + k, top)].astype(np.int64) & 63 for k in (1, 2, 3)]
    two = (first & 31) << 6 | tail[0]
    three = (first & 15) << 12 | tail[0] << 6 | tail[1]
    four = (first & 7) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
    point = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    kind = table[np.minimum(point, 0x10FFFF)]
    made[lead] = kind
    for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
        there = (first >= least) & (lead + k <= top)
        made[lead[there] + k] = kind[there]
    return made


def find_all(flat: np.ndarray, offsets: np.ndarray, what: bytes) -> np.ndarray:
    """Where ``what`` begins, from left to right without overlap and inside one row."""
    raw, found, at = flat.tobytes(), [], 0
    while (at := raw.find(what, at)) >= 0:
        row = int(np.searchsorted(offsets, at, side="right")) - 1
        if at + len(what) <= offsets[row + 1]:
            found.append(at)
            at += len(what)
        else:
            at = int(offsets[row + 1])
    return np.array(found, np.int64)


def cut(flat: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, dict]:
    """Where each pre-token begins (it ends where the next begins), and {begin: special} for the
    special tokens among them, which end the text before them and begin a new one."""
    size = len(flat)
    if not size:
        return np.zeros(0, np.int64), {}
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    marked: dict[int, bytes] = {}
    for what in special:
        for at in find_all(flat, offsets, what).tolist():
            marked[at] = what
            edge[[at, at + len(what)]] = True
    kind = byte_classes(flat)
    start = np.ones(size, bool)
    start[1:] = (kind[1:] != kind[:-1]) | edge[1:size]
    space = kind == SPACE
    after = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:size]) + 1
    before = after - 1
    for _ in range(3):
        before = np.where(flat[before] & 0xC0 == 0x80, before - 1, before)
    start[before] = True
    start[after[flat[before] == 0x20]] = False
    quote = np.flatnonzero((flat == 0x27) & start)
    if len(quote):
        padded = np.append(flat, np.zeros(2, np.uint8))
        one, two = padded[quote + 1], padded[quote + 2]
        inner = ~edge[quote + 1]
        short = inner & np.isin(one, np.frombuffer(SHORT_ENDINGS, np.uint8))
        long = np.zeros(len(quote), bool)
        for a, b in LONG_ENDINGS:
            long |= (one == a) & (two == b)
        long &= inner & ~edge[np.minimum(quote + 2, size)]
        start[quote[short | long] + 1] = False
        ends = np.concatenate([quote[short] + 2, quote[long] + 3])
        start[ends[ends < size]] = True
    for at, what in marked.items():
        start[at] = True
        start[at + 1 : at + len(what)] = False
    return np.flatnonzero(start), marked


def hashes(flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pre-token, never 0."""
    return span_hashes(flat, begin, np.append(begin[1:], len(flat))) | np.uint64(1)


def spans(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - length), length)


class IdTable:
    """Ids of the pre-tokens that a worker has met, by hash; begins anew when it is full.

    Two different pre-tokens share a 63-bit hash with a chance of about n**2 / 2**64.
    """

    def __init__(self, slots: int = 1 << 20) -> None:
        self.slots = slots
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.entry = np.zeros(self.slots, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def full(self, more: int) -> bool:
        return len(self.begin) + more > self.slots * 3 // 4

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 if there is none."""
        shift = np.uint64(64 - (self.slots - 1).bit_length())
        mask = self.slots - 1
        made = np.full(len(wanted), -1, np.int32)
        left = np.arange(len(wanted))
        at = (wanted >> shift).astype(np.int64)
        while len(left):
            there = self.keys[at]
            hit = there == wanted[left]
            made[left[hit]] = self.entry[at[hit]]
            go_on = ~hit & (there != 0)
            left, at = left[go_on], (at[go_on] + 1) & mask
        return made

    def add(self, new: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Put in hashes that are distinct and not there yet."""
        base = len(self.begin)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        shift = np.uint64(64 - (self.slots - 1).bit_length())
        mask = self.slots - 1
        left = np.arange(len(new))
        at = (new >> shift).astype(np.int64)
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = new[left[free]]
            won = free & (self.keys[at] == new[left])
            self.entry[at[won]] = base + left[won]
            left, at = left[~won], (at[~won] + 1) & mask
