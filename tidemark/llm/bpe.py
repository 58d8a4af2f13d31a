"""BPE encoding and decoding with a pair occurrence index.

Text is cut into byte-level pre-tokens. Those of one Arrow batch that the worker has not met are
encoded together: an index maps every pair of neighbouring symbols that has a merge to all its
positions, the ranks in use are applied in ascending order to all their positions at once, and the
lists of the pairs beside each merge are updated. A merge makes a symbol that only later merges
use, so this equals the merging of each word alone. Words met before come from a bounded table.

Null text is empty; an empty text has no ids. Special tokens of the vocabulary file that stand in a
text are cut out first, as its library does. Any length of text is encoded whole; equal rows give
equal ids; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import pretokens
from tidemark.llm.common import chunks, keyed_text, pack_lists, text_bytes

#: Bytes of text that are cut into words at once, and whose words are encoded together.
AT_ONCE, TOGETHER = 1 << 18, 2 << 20


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    made, following = [], 256
    for byte in range(256):
        if byte in own:
            made.append(chr(byte))
        else:
            made.append(chr(following))
            following += 1
    return made


class PairIndexEncoder:
    """Encodes and decodes with one byte-level BPE vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        vocab = whole["model"]["vocab"]
        characters = byte_characters()
        byte_of = {c: b for b, c in enumerate(characters)}
        self.first_ids = np.array([vocab[c] for c in characters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in whole["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = self.left.astype(np.int64) << 32 | self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.special = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
        strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if s not in self.special}
        strings |= {i: s.encode() for s, i in self.special.items()}
        size = max(strings) + 1
        self.spelling = [strings.get(i, b"") for i in range(size)]
        self.spelled = np.frombuffer(b"".join(self.spelling), np.uint8)
        self.length = np.array([len(s) for s in self.spelling], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it has no merge."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def encode_words(
        self, letters: np.ndarray, lengths: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, whose bytes stand one after the other, and how many each word has."""
        symbols = self.first_ids[letters]
        size = len(symbols)
        if not size:
            return symbols, lengths
        word_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        following = np.arange(1, size + 1, dtype=np.int32)
        following[np.flatnonzero(np.append(word_of[1:] != word_of[:-1], True))] = -1
        before = np.arange(-1, size - 1, dtype=np.int32)
        before[np.flatnonzero(np.append(True, word_of[1:] != word_of[:-1]))] = -1
        alive = np.ones(size, bool)
        index: dict[int, list[np.ndarray]] = defaultdict(list)
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            """Put the pairs that begin at these positions into the index."""
            ranks = self.rank_of(symbols[at], symbols[following[at]])
            there = ranks >= 0
            if not there.any():
                return
            at, ranks = at[there], ranks[there]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            edges = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1]))
            for rank, group in zip(ranks[edges].tolist(), np.split(at, edges[1:]), strict=True):
                if rank not in index:
                    heapq.heappush(heap, rank)
                index[rank].append(group)

        add(np.flatnonzero(following >= 0))
        while heap:
            rank = heapq.heappop(heap)
            groups = index.pop(rank)
            at = groups[0] if len(groups) == 1 else np.concatenate(groups)
            left, right, new = self.left[rank], self.right[rank], self.made[rank]
            at = at[alive[at] & (symbols[at] == left) & (following[at] >= 0)]
            at = at[symbols[following[at]] == right]
            if len(groups) > 1:
                at = np.unique(at)
            if left == right and len(at) > 1:
                at = np.sort(at)
                fresh = np.append(True, at[1:] != following[at[:-1]])
                runs = np.flatnonzero(fresh)
                place = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
                at = at[place % 2 == 0]
            if not len(at):
                continue
            gone = following[at]
            after = following[gone]
            symbols[at] = new
            alive[gone] = False
            following[at] = after
            inner = after >= 0
            before[after[inner]] = at[inner]
            previous = before[at]
            near = np.concatenate([previous[previous >= 0], at[inner]])
            if len(near):
                add(np.unique(near))
        counts = np.bincount(word_of[alive], minlength=len(lengths))
        return symbols[alive], counts

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each row of ids; bytes that are not UTF-8 become replacement characters."""
        lengths = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        shift = np.repeat(self.start[ids] - ends[:-1], lengths)
        raw = self.spelled[np.arange(ends[-1]) + shift].tobytes()
        bounds = ends[offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:], strict=False)]


Words = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class TextEncoder:
    """Ids of whole texts; ``encode_words`` does the words that the table doesn't hold yet."""

    def __init__(self, encode_words: Words, special: dict[str, int]) -> None:
        self.encode_words = encode_words
        self.special = {s.encode(): i for s, i in special.items()}
        self.table = pretokens.IdTable()

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after the other, and where each row's begin (and all end)."""
        parts = []
        fresh: list[np.ndarray] = []
        for a, b in chunks(offsets, AT_ONCE):
            text, rows = flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            begin, marked = pretokens.cut(text, rows, list(self.special))
            codes = pretokens.hashes(text, begin)
            parts.append((a, b, begin.astype(np.int32), codes, marked))
            missing = np.flatnonzero(self.table.find(codes) < 0)
            if len(missing):
                codes, which = np.unique(codes[missing], return_index=True)
                at = missing[which]
                length = np.append(begin, len(text))[at + 1] - begin[at]
                fresh.append((codes, begin[at] + offsets[a], length))
        if fresh:
            self._learn(flat, *map(np.concatenate, zip(*fresh, strict=True)))
        ids, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        total = 0
        for a, b, begin, codes, marked in parts:
            entry = self.table.find(codes)
            count = self.table.count[entry]
            upto = np.concatenate([[0], np.cumsum(count)])
            made = self.table.ids[pretokens.spans(self.table.begin[entry], count)]
            if marked:
                made, upto = self._put_special(made, upto, begin, marked)
            ids.append(made)
            row_ends = np.searchsorted(begin, offsets[a + 1 : b + 1] - offsets[a])
            ends.append(total + upto[row_ends])
            total += int(upto[-1])
        return np.concatenate(ids), np.concatenate(ends)

    def encode_batches(
        self, batches: Iterator[pa.RecordBatch]
    ) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """(ids of rows, ids of tokens, where each row's begin) for parts of batches (id, text)."""
        for batch in batches:
            flat, rows = text_bytes(batch.column("text"))
            for a, b in chunks(rows, TOGETHER):
                part = flat[rows[a] : rows[b]]
                if self.table.full(len(part) // 16):
                    self.table.clear()
                ids, offsets = self.encode(part, rows[a : b + 1] - rows[a])
                yield batch.column("id").slice(a, b - a), ids, offsets

    def _put_special(
        self, ids: np.ndarray, upto: np.ndarray, begin: np.ndarray, marked: dict[int, bytes]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Put the ids of special tokens in place of those of their letters."""
        groups = np.split(ids, upto[1:-1])
        for at, what in marked.items():
            groups[int(np.searchsorted(begin, at))] = np.array([self.special[what]], np.int32)
        return np.concatenate(groups), np.concatenate([[0], np.cumsum([len(g) for g in groups])])

    def _learn(
        self, flat: np.ndarray, codes: np.ndarray, begin: np.ndarray, length: np.ndarray
    ) -> None:
        codes, which = np.unique(codes, return_index=True)
        begin, length = begin[which], length[which]
        ids, counts = self.encode_words(flat[pretokens.spans(begin, length)], length)
        self.table.add(codes, ids, counts)


@cache
def spelling(path: str) -> PairIndexEncoder:
    """One vocabulary for each worker and file."""
    return PairIndexEncoder(path)


@cache
def encoder(path: str) -> TextEncoder:
    """One encoder for each worker and vocabulary file."""
    own = spelling(path)
    return TextEncoder(own.encode_words, own.special)


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) of every row of ``docs``. ``vocabulary`` is a file all workers read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for first, ids, offsets in own.encode_batches(batches):
            yield pa.RecordBatch.from_arrays([first, pack_lists(ids, offsets, pa.int32())], ["id", "ids"])

    return keyed_text(docs, id_col, text_col).mapInArrow(work, "id long, ids array<int>")


def _spelled(
    own: PairIndexEncoder, keys: pa.Array, ids: np.ndarray, offsets: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """(id, ids, text) of rows of ids, some hundreds at a time."""
    for a in range(0, len(keys), 512):
        part = offsets[a : min(a + 512, len(keys)) + 1]
        flat = ids[part[0] : part[-1]]
        texts = own.decode(flat, part - part[0])
        lists = pack_lists(flat, part - part[0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [keys.slice(a, len(part) - 1), lists, pa.array(texts, pa.string())], ["id", "ids", "text"]
        )


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(id, ids, text): the ids spelled out again, special tokens included. Null ids are no ids."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ids = ids.fill_null([]) if ids.null_count else ids
            offsets = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False)
            yield from _spelled(spelling(vocabulary), batch.column("id"), flat, offsets)

    return encoded.select("id", "ids").mapInArrow(spell, "id long, ids array<int>, text string")


def round_trip(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids, text): :func:`encode` and then :func:`decode`, in one worker for each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, offsets in encoder(vocabulary).encode_batches(batches):
            yield from _spelled(spelling(vocabulary), keys, ids, offsets)
        pa.default_memory_pool().release_unused()

    return keyed_text(docs, id_col, text_col).mapInArrow(
        work, "id long, ids array<int>, text string"
    )
