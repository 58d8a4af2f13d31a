"""Token ids in binary files, compressed by Re-Pair per block of a shard.

A shard is a range of document ids in one task; it is cut into blocks of whole documents. In a
block the most frequent pairs of neighbouring ids become nonterminals, round after round, until no
pair is frequent. A block stores its rules, the number of ids each nonterminal expands to, and the
remaining sequence; with those lengths any range of ids is decoded without the rest. Blocks are
rows of a Parquet table that Spark writes, so a lost task is written anew and never half.

Null text is empty and gives the end id alone. Rows with equal ids stand in the order of their
texts, rows without an id first. An empty table gives no files with rows. Other columns are not
looked at. A very long text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import TextEncoder
from tidemark.llm.common import keyed_text

#: Ids in a block, where a document doesn't make it longer.
BLOCK = 1 << 17
#: Words given to the library at once.
WORDS = 4096
#: A pair must occur this often in a block, without overlap, to become a rule.
LEAST = 16

SCHEMA = (
    "shard int, block long, ids_before long, n_ids long, doc_ids array<long>, "
    "doc_sizes array<int>, rules binary, lengths binary, sequence binary"
)


def apart(sequence: np.ndarray) -> np.ndarray:
    """Which pairs of neighbours count: all, but of a run of equal ids only the 1st, 3rd, 5th."""
    made = np.ones(len(sequence) - 1, bool)
    same = np.flatnonzero(sequence[1:] == sequence[:-1])
    if len(same):
        new = np.append(True, np.diff(same) > 1)
        place = np.arange(len(same)) - np.maximum.accumulate(np.where(new, np.arange(len(same)), 0))
        made[same[place % 2 == 1]] = False
    return made


def replace_pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, rules (n, 2), first nonterminal) of one block.

    Rounds go on until no pair occurs ``LEAST`` times. Pairs replaced in the same round begin with
    symbols that no other of them ends with, so their occurrences can't overlap and the result
    doesn't depend on an order of replacement. Of a run of equal ids every second pair counts.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    sequence, following = ids.astype(np.int64), base
    rules: list[np.ndarray] = []
    while len(sequence) >= 2 * LEAST:
        alone = apart(sequence)
        keys = sequence[:-1] << 32 | sequence[1:]
        # a frequent pair is in a bucket that is at least as full: only those are sorted
        bucket = (sequence[:-1] * 0x9E3779B1 + sequence[1:] * 0x85EBCA77) >> 7 & (1 << 17) - 1
        full = np.bincount(bucket[alone], minlength=1 << 17) >= LEAST
        ordered = np.sort(keys[full[bucket] & alone])
        if not len(ordered):
            break
        edges = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        counts = np.diff(np.append(edges, len(ordered)))
        often = np.flatnonzero(counts >= LEAST)
        if not len(often):
            break
        pairs = ordered[edges[often]]
        pairs = pairs[np.argsort(-counts[often], kind="stable")]
        begins: set[int] = set()
        ends: set[int] = set()
        chosen = []
        for key, a, b in zip(
            pairs.tolist(), (pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True
        ):
            if a not in ends and b not in begins:
                begins.add(a)
                ends.add(b)
                chosen.append(key)
        table = np.sort(np.array(chosen, np.int64))
        first = np.zeros(following, bool)
        first[table >> 32] = True
        at = np.flatnonzero(first[sequence[:-1]] & alone)
        place = np.minimum(np.searchsorted(table, keys[at]), len(table) - 1)
        hit = table[place] == keys[at]
        at, place = at[hit], place[hit]
        sequence[at] = following + place
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence = sequence[keep]
        rules.append(np.stack([table >> 32, table & 0xFFFFFFFF], axis=1))
        following += len(table)
    made = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return sequence, made, base


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each nonterminal stands for. A rule names only earlier symbols."""
    lengths = np.ones(len(rules), np.int64)
    depth = np.zeros(len(rules), np.int64)
    while True:
        sides = [np.where(s >= base, lengths[np.maximum(s - base, 0)], 1) for s in rules.T]
        after = sides[0] + sides[1] if len(rules) else depth
        if np.array_equal(after, lengths):
            return lengths
        lengths = after


def expand(sequence: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that a sequence stands for."""
    while True:
        inner = sequence >= base
        if not inner.any():
            return sequence
        size = 1 + inner
        at = np.cumsum(size) - size
        made = np.empty(int(size.sum()), sequence.dtype)
        made[at] = np.where(inner, rules[np.where(inner, sequence - base, 0), 0], sequence)
        made[at[inner] + 1] = rules[sequence[inner] - base, 1]
        sequence = made


def pack(values: np.ndarray) -> bytes:
    """Little-endian integers of the smallest width that holds them, which the first byte tells."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


class Block:
    """A stored block: random access to its ids."""

    def __init__(self, rules: bytes, lengths: bytes, sequence: bytes) -> None:
        flat = unpack(rules)
        self.base, self.rules = int(flat[0]), flat[1:].reshape(-1, 2)
        names = unpack(sequence)
        used = int(names[0])
        self.sequence = names[1 : 1 + used][names[1 + used :]]
        size = unpack(lengths)
        symbol = np.where(
            self.sequence >= self.base,
            size[np.maximum(self.sequence - self.base, 0)] if len(size) else 1,
            1,
        )
        self.ends = np.cumsum(symbol)

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive); only the symbols that cover them are expanded."""
        total = int(self.ends[-1]) if len(self.ends) else 0
        last = total if last is None else min(last, total)
        if first >= last:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.ends, first, side="right"))
        b = int(np.searchsorted(self.ends, last, side="left")) + 1
        skipped = int(self.ends[a - 1]) if a else 0
        return expand(self.sequence[a:b], self.rules, self.base)[first - skipped : last - skipped]


def store(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(rules, lengths, sequence) of a block as bytes. The sequence names its own few symbols by
    their place in a list, which mostly needs two bytes for each."""
    sequence, rules, base = replace_pairs(ids)
    used = np.zeros(base + len(rules), bool)
    used[sequence] = True
    symbols = np.flatnonzero(used)
    place = np.zeros(base + len(rules), np.int64)
    place[symbols] = np.arange(len(symbols))
    names = np.concatenate([[len(symbols)], symbols, place[sequence]])
    flat = np.concatenate([[base], rules.ravel()])
    return pack(flat), pack(expansion_lengths(rules, base)), pack(names)


def separator(own: Tokenizer) -> str | None:
    """A special token that parts texts exactly: it takes no white space from its neighbours and
    doesn't end as it begins, so no occurrence of it can lie across its edges."""
    for token in own.get_added_tokens_decoder().values():
        text = token.content
        apart = not any(text[:k] == text[-k:] for k in range(1, len(text)))
        if token.special and apart and not (token.lstrip or token.rstrip or token.single_word or token.normalized):
            return text
    return None


@cache
def library_encoder(path: str) -> TextEncoder:
    """Whole texts by the tokenizers library: it encodes the words that a worker hasn't met."""
    own = Tokenizer.from_file(path)
    special = {t.content: i for i, t in own.get_added_tokens_decoder().items()}

    between = separator(own)

    def encode_some(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if between is None or between in words:
            made = own.encode(words, is_pretokenized=True, add_special_tokens=False)
            counts = np.bincount(np.array(made.word_ids, np.int64), minlength=len(words))
            return np.array(made.ids, np.int32), counts
        made = own.encode_batch_fast([between.join(words)], add_special_tokens=False)[0].ids
        ids = np.array(made, np.int32)
        cuts = np.flatnonzero(ids == special[between])
        return np.delete(ids, cuts), np.diff(cuts, prepend=-1, append=len(ids)) - 1

    def encode_words(letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, ends = letters.tobytes(), np.concatenate([[0], np.cumsum(lengths)]).tolist()
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for k in range(0, len(lengths), WORDS):
            some = ends[k : k + WORDS + 1]
            made, of = encode_some([raw[a:b].decode() for a, b in zip(some, some[1:], strict=False)])
            ids.append(made)
            counts.append(of)
        return np.concatenate(ids), np.concatenate(counts)

    return TextEncoder(encode_words, special)


def write_ids(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every row, end it with ``end_id`` and write the ids in ascending order of ``id_col``."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        own = library_encoder(vocabulary)
        before, block, held = 0, 0, 0
        keys: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            rules, lengths, sequence = store(np.concatenate(ids))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([before], pa.int64()),
                    pa.array([held], pa.int64()),
                    pack_lists_of(pa.concat_arrays(keys)),
                    pack_lists_of(pa.array(np.concatenate(sizes), pa.int32())),
                    *(pa.array([x], pa.binary()) for x in (rules, lengths, sequence)),
                ],
                [part.split(" ")[0] for part in SCHEMA.split(", ")],
            )

        for rows, made, ends in own.encode_batches(batches):
            made = np.insert(made, ends[1:], end_id)
            ends = ends + np.arange(len(ends))
            first = 0
            while first < len(ends) - 1:
                room = max(BLOCK - held, 1)
                last = int(np.searchsorted(ends, ends[first] + room, side="right")) - 1
                last = max(last, first + 1)
                keys.append(rows.slice(first, last - first))
                sizes.append(np.diff(ends[first : last + 1]))
                ids.append(made[ends[first] : ends[last]])
                held += int(ends[last] - ends[first])
                first = last
                if held >= BLOCK * 7 // 8:
                    yield flush()
                    before, block, held = before + held, block + 1, 0
                    keys, sizes, ids = [], [], []
        if held:
            yield flush()
        pa.default_memory_pool().release_unused()

    text = keyed_text(docs, id_col, text_col)
    sorted_text = text.repartitionByRange("id").sortWithinPartitions("id", "text")
    sorted_text.mapInArrow(shard, SCHEMA).write.parquet(path)


def pack_lists_of(values: pa.Array) -> pa.Array:
    """One row: the list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with ``start``: the number of ids in all blocks before. Only the totals of the
    shards, one row for each task that wrote, meet in one place."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_at"))
    return blocks.join(F.broadcast(totals), "shard").withColumn(
        "start", F.col("shard_at") + F.col("ids_before")
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, ids) of every document, decoded from the files; ids are little-endian unsigned
    32-bit integers one after the other."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at, keys, sizes, rules, lengths, sequence = (c[row] for c in batch.columns)
                ids = Block(rules.as_py(), lengths.as_py(), sequence.as_py()).ids()
                ends = np.concatenate([[0], np.cumsum(sizes.values.to_numpy())])
                raw, cuts = ids.astype("<u4").tobytes(), (4 * ends).tolist()
                packed = [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.values,
                        pa.array(at.as_py() + ends[:-1], pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["id", "start", "ids"],
                )

    blocks = read_blocks(spark, path)
    return blocks.select("start", "doc_ids", "doc_sizes", "rules", "lengths", "sequence").mapInArrow(
        decode, "id long, start long, ids binary"
    )
