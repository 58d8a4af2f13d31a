"""SimHash fingerprints and the permuted block tables that search them.

A document's terms are its shingles of three words (a shorter document is one term), each as often
as it occurs. Every occurrence votes on the signed bits of its hash; the fingerprint has the bits
with more votes for than against. The likeness of two fingerprints is the cosine that their Hamming
distance estimates, not below 0.

To find all fingerprints within a Hamming radius the bits are cut into ``radius + keyed`` blocks:
two fingerprints within the radius agree in at least ``keyed`` of them, so a table for each choice of
``keyed`` blocks, keyed by their bits, finds every pair. Equal fingerprints are searched once.

``count_likely`` does so for a wide radius: of ``BLOCKS`` blocks of 16 bits one at least differs in
two bits or fewer if the fingerprints are no more than ``RADIUS = 3 * BLOCKS - 1`` bits apart. Those
asked about are looked up under every key that near their own. A pair counts in the first of the
tables that find it, and tables send sums, not pairs.

A null or empty text has no terms and the fingerprint 0, like any text without words. Equal texts
have equal fingerprints. Rows with the same id stand in the order of their texts. A table of one row
is its own next document; an empty one gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, keyed_text, mix, partitions, text_bytes
from tidemark.llm.words import shingle_hashes, word_hashes

BITS = 256
WIDTH = 3
AT_ONCE = 1 << 19
#: Tables of ``count_likely``, and the distance up to which they find every pair.
BLOCKS = BITS // 16
RADIUS = 3 * BLOCKS - 1


def fingerprints(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, BITS / 8) bytes."""
    rows = len(offsets) - 1
    made = np.zeros((rows, BITS // 8), np.uint8)
    for a, b in chunks(offsets, AT_ONCE):
        words, first = word_hashes(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        terms, row_of = shingle_hashes(words, first, WIDTH)
        if not len(terms):
            continue
        present, begin = np.unique(row_of, return_index=True)
        votes = np.diff(np.append(begin, len(terms)))[:, None]
        side = terms
        for k in range(BITS // 64):
            bits = np.unpackbits(side.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            won = 2 * np.add.reduceat(bits, begin, axis=0, dtype=np.int32) > votes
            made[a + present, 8 * k : 8 * k + 8] = np.packbits(won, axis=1)
            side = mix(side + np.uint64(0x9E3779B97F4A7C15))
    return made


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The estimated cosine of the terms of each pair of rows, 0 to 1."""
    apart = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    return np.clip(np.cos(np.pi * apart / BITS), 0, 1)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint hex) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [p.tobytes().hex() for p in fingerprints(*text_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(prints, pa.string())], ["id", "fingerprint"]
            )

    return keyed_text(docs, id_col, text_col).mapInArrow(work, "id long, fingerprint string")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, bucket, bridge) in ascending order within partitions, so that the row after each
    is its next document: the text moves once.

    Buckets are ranges of ids of about equal size. The first document of each bucket also ends the
    bucket before (the very first one, the last bucket) as a bridge.
    """
    text = keyed_text(docs, id_col, text_col)
    ids = text.select("id")
    count = 2 * partitions(docs.sparkSession)
    bounds = ids.approxQuantile("id", [k / count for k in range(1, count)], 1 / (8 * count))
    bounds = sorted(set(int(b) for b in bounds))
    at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda x: x <= F.col("id"))) if bounds else F.lit(0)
    bucket = F.when(F.col("id").isNull(), 0).otherwise(at)
    firsts = ids.groupBy(bucket.alias("bucket")).agg(
        F.min("id").alias("first"), F.max(F.col("id").isNull()).alias("has_null")
    ).collect()  # one row for each bucket
    firsts = sorted(firsts, key=lambda r: r["bucket"])
    starts = [None if r["has_null"] else r["first"] for r in firsts]
    before = [(firsts[k - 1]["bucket"], s) for k, s in enumerate(starts)]
    text = text.withColumn("bucket", bucket)
    if not before:
        return text.withColumn("bridge", F.lit(False))
    spark = docs.sparkSession
    to = spark.createDataFrame(before, "to int, start long")
    bridges = text.join(F.broadcast(to), F.col("id").eqNullSafe(F.col("start")))
    bridges = bridges.groupBy("to", "id").agg(F.min("text").alias("text"))
    whole = text.withColumn("bridge", F.lit(False)).unionByName(
        bridges.select("id", "text", F.col("to").alias("bucket"), F.lit(True).alias("bridge"))
    )
    dealt = whole.repartition(partitions(spark), "bucket")
    return dealt.sortWithinPartitions("bucket", "bridge", "id", "text")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the text that has its last quarter replaced by the beginning of the next
    document: id, n_chars, edited_sha256, the two fingerprints, and near_edited and near_next."""
    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def compare(
        ids: list[int | None], texts: list[str], own: np.ndarray, bridge: list[bool]
    ) -> pa.RecordBatch:
        """Rows of all but the last of these documents, each with the one after it."""
        rows = [k for k in range(len(texts) - 1) if not bridge[k]]
        edited = []
        for k in rows:
            part = len(texts[k]) // 4
            edited.append(texts[k][: len(texts[k]) - part] + texts[k + 1][:part])
        changed = fingerprints(*text_bytes(pa.array(edited, pa.string())))
        at = np.array(rows, np.int64)
        columns = [
            pa.array([ids[k] for k in rows], pa.int64()),
            pa.array([len(texts[k]) for k in rows], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([own[k].tobytes().hex() for k in rows], pa.string()),
            pa.array([c.tobytes().hex() for c in changed], pa.string()),
            pa.array(likeness(own[at], changed), pa.float64()),
            pa.array(likeness(own[at], own[at + 1]), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in schema.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        bridge: list[bool] = []
        own = np.zeros((0, BITS // 8), np.uint8)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, 4 << 20):
                part = batch.slice(a, b - a)
                ids += part.column("id").to_pylist()
                texts += part.column("text").to_pylist()
                bridge += part.column("bridge").to_pylist()
                own = np.concatenate([own, fingerprints(*text_bytes(part.column("text")))])
                yield compare(ids, texts, own, bridge)
                ids, texts, bridge, own = ids[-1:], texts[-1:], bridge[-1:], own[-1:]

    dealt = with_next(docs, id_col, text_col).select("id", "text", "bridge")
    return dealt.mapInArrow(work, schema)


def within_radius(
    prints: DataFrame, asked: DataFrame, radius: int = 3, keyed: int = 1
) -> DataFrame:
    """(asked, found, distance) for all distinct fingerprints ``found`` of ``prints`` (column
    fingerprint, hex) within ``radius`` of those ``asked`` (same column), equal ones included."""
    blocks = radius + keyed
    if BITS // 4 < blocks:
        raise ValueError(f"{blocks} blocks are more than the fingerprint's {BITS // 4} digits")
    digits = [BITS // 4 * k // blocks for k in range(blocks + 1)]
    choices = list(combinations(range(blocks), keyed))
    assert len(choices) == comb(blocks, keyed)

    def tables(df: DataFrame, name: str) -> DataFrame:
        own = df.select(F.col("fingerprint").alias(name)).distinct()
        keys = [
            F.concat_ws(
                "-",
                F.lit(str(n)),
                *(F.substring(name, digits[k] + 1, digits[k + 1] - digits[k]) for k in choice),
            )
            for n, choice in enumerate(choices)
        ]
        return own.select(name, F.explode(F.array(*keys)).alias("key"))

    halves = [
        F.bit_count(
            F.conv(F.substring("asked", p, 8), 16, 10).cast("long").bitwiseXOR(
                F.conv(F.substring("found", p, 8), 16, 10).cast("long")
            )
        )
        for p in range(1, BITS // 4, 8)
    ]
    distance = sum(halves[1:], halves[0])
    pairs = tables(asked, "asked").join(tables(prints, "found"), "key")
    pairs = pairs.withColumn("distance", distance).where(F.col("distance") <= radius)
    return pairs.select("asked", "found", "distance").distinct()


def count_near(prints: DataFrame, asked: DataFrame, radius: int = 3, keyed: int = 1) -> DataFrame:
    """(fingerprint, n_near): how many rows of ``prints`` lie within ``radius`` of each distinct
    fingerprint of ``asked``, rows with the same one included."""
    copies = prints.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    found = within_radius(prints, asked, radius, keyed)
    found = found.join(copies, F.col("found") == F.col("fingerprint"))
    return found.groupBy(F.col("asked").alias("fingerprint")).agg(F.sum("copies").alias("n_near"))


def count_likely(prints: DataFrame, asked: DataFrame) -> DataFrame:
    """``count_near`` for a radius of ``RADIUS`` bits."""
    spark = prints.sparkSession
    buckets = max(1, 4 * partitions(spark) // BLOCKS)
    flips = np.array([0] + [1 << k | 1 << j for k in range(16) for j in range(k + 1)], "<u2")
    copies = prints.groupBy("fingerprint").agg(F.count("*").alias("copies"))
    rows = copies.withColumn("asks", F.lit(False)).unionByName(
        asked.select("fingerprint").distinct().select("*", F.lit(0).cast("long").alias("copies"), F.lit(True).alias("asks"))
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each fragment of a table and side: keys, fingerprints and their copies."""
        for batch in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
            raw = bytes.fromhex("".join(batch.column("fingerprint").to_pylist()))
            own = np.frombuffer(raw, np.uint8).reshape(-1, BITS // 8)
            copies = batch.column("copies").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            made: tuple[list, ...] = ([], [], [], [], [])
            for side in (True, False):
                at = np.flatnonzero(asks == side)
                for block in range(BLOCKS):
                    key = own[at, 2 * block : 2 * block + 2].copy().view("<u2")
                    key = (key ^ flips if side else key).ravel()
                    row = np.repeat(at, len(flips)) if side else at
                    bucket = (mix(key.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                    for k in np.unique(bucket).tolist():
                        here = bucket == k
                        made[0].append(block * buckets + k)
                        made[1].append(not side)
                        made[2].append(key[here].tobytes())
                        made[3].append(own[row[here]].tobytes())
                        made[4].append(copies[row[here]].astype("<i8").tobytes())
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(m, k) for m, k in zip(made, kinds, strict=True)],
                ["fragment", "held", "keys", "prints", "copies"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of every fragment; the rows that ask come before those that are held."""
        current, asking, index = None, [], None

        def sums() -> pa.RecordBatch:
            _, who, total = index
            some = np.flatnonzero(total)
            names, place = np.unique(who[some], axis=0, return_inverse=True)
            added = np.zeros(len(names), np.int64)
            np.add.at(added, place.ravel(), total[some])
            return pa.RecordBatch.from_arrays(
                [pa.array([n.tobytes().hex() for n in names], pa.string()), pa.array(added)],
                ["fingerprint", "n"],
            )

        for batch in batches:
            for at in range(batch.num_rows):
                fragment, held, *parts = (batch.column(k)[at].as_py() for k in range(5))
                if fragment != current:
                    if index:
                        yield sums()
                    current, asking, index = fragment, [], None
                key = np.frombuffer(parts[0], "<u2")
                own = np.frombuffer(parts[1], np.uint8).reshape(-1, BITS // 8)
                if not held:
                    asking.append((key, own))
                    continue
                if not asking:
                    continue
                if index is None:
                    keys, who = (np.concatenate(x) for x in zip(*asking, strict=True))
                    order = np.argsort(keys, kind="stable")
                    index = keys[order], who[order], np.zeros(len(keys), np.int64)
                _add_near(index, fragment // buckets, key, own, np.frombuffer(parts[2], "<i8"))
        if index:
            yield sums()

    dealt = rows.select("fingerprint", "copies", "asks").mapInArrow(
        deal, "fragment int, held boolean, keys binary, prints binary, copies binary"
    )
    dealt = dealt.repartition(partitions(spark), "fragment").sortWithinPartitions("fragment", "held")
    found = dealt.mapInArrow(count, "fingerprint string, n long")
    return found.groupBy("fingerprint").agg(F.sum("n").alias("n_near"))


def _add_near(
    index: tuple[np.ndarray, ...], block: int, key: np.ndarray, own: np.ndarray, copies: np.ndarray
) -> None:
    """Add the copies of these fingerprints to those of the index that they are near to, if no table
    before ``block`` finds the pair."""
    keys, who, total = index
    begin = np.searchsorted(keys, key, "left")
    length = np.searchsorted(keys, key, "right") - begin
    for a, b in chunks(np.append(0, np.cumsum(length)), AT_ONCE // 2):
        ends = np.cumsum(length[a:b])
        if not len(ends) or not ends[-1]:
            continue
        mine = np.repeat(np.arange(a, b), length[a:b])
        at = np.arange(int(ends[-1])) + np.repeat(begin[a:b] - (ends - length[a:b]), length[a:b])
        apart = np.bitwise_count(who[at].view("<u2") ^ own[mine].view("<u2"))
        near = (apart.sum(axis=1, dtype=np.int64) <= RADIUS) & (np.argmax(apart <= 2, axis=1) == block)
        np.add.at(total, at[near], copies[mine[near]])
