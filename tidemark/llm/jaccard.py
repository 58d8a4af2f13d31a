"""N-gram Jaccard join by vertical partitioning.

A document's set holds its distinct shingles of five words as 64-bit hashes; with fewer words, the
whole sequence. Documents with equal sets are one class. The shingles are cut into fragments, which
are worked on apart:

1. Of each class the first half (and a little more) of its shingles in hash order goes to their
   fragments (``sent_first``). Of these at least ``1 + n // 4`` must be among those that a class it
   links with sends as well; the fragments count them apart, the sums decide. Classes below that
   have no links and leave.
2. The fragments count in how many of the remaining classes each shingle is. The global order is by
   that count (as a power of two), then by hash; shingles that only one class has are left out.
3. Any two classes that link share one of the first ``n - ceil(0.75 n) + 1`` shingles of that order.
   Each class is first compared with one other of these, the one whose shingles are the most common:
   a pair's overlap is counted for each fragment of the global order apart and summed.
4. As only components are asked for, what is left are classes that share such a shingle but are in
   different components so far. Components, and classes still alone by what they were compared
   with, are cut into blocks of ``BLOCK``; a class goes to the blocks that it has to be compared
   with, once to each, from the smaller side to the larger. What links is found by exact overlap.

Null and empty texts, and those without words, have empty sets and link with nothing. Repeated rows
and ids are answered row by row. A null id is reached and reaches, but is never a component's name
unless no other is there. An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, components, keyed_text, mix, partitions, text_bytes
from tidemark.llm.words import shingle_hashes, word_hashes
from tidemark.shared import write_and_read

WIDTH = 5
#: Similarity as a fraction: 100 * intersection >= PERCENT * union.
PERCENT = 75
AT_ONCE = 1 << 20
#: Classes that are held together while others are compared with them.
BLOCK = 512


def least_common(n: np.ndarray) -> np.ndarray:
    """How many shingles a set of n at least shares with one it links with: ceil(0.75 n)."""
    return -(-n * PERCENT // 100)


def sent_first(n: np.ndarray) -> np.ndarray:
    """How many shingles a set of n sends in step 1, so that two sets that link both count enough.

    With c in common and all others first, a set of m that sends s counts on ``s - (m - c)`` of them.
    For its own size that is ``1 + n // 4`` at least. For the count of a larger set of n it is too
    where m >= 14, as ``c >= 3 (m + n) / 7``; of the smaller ones only 3 of 4 needs one more.
    """
    return np.minimum(n, n - least_common(n) + 1 + n // 4 + (n == 3))


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets) for parts of a text column: the sorted set of every row."""
    flat, offsets = text_bytes(column)
    for a, b in chunks(offsets, AT_ONCE):
        words, first = word_hashes(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes, row_of = shingle_hashes(words, first, width)
        order = np.lexsort((hashes, row_of))
        hashes, row_of = hashes[order], row_of[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row_of[1:] != row_of[:-1])
        hashes, row_of = hashes[new], row_of[new]
        yield a, hashes, np.searchsorted(row_of, np.arange(b - a + 1))


def class_of(hashes: np.ndarray) -> int:
    """The name of a set: equal sets have equal names."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def classes(text: DataFrame) -> DataFrame:
    """(id, class, n) of every row (id, text): the name and the size of its set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, offsets in shingle_sets(batch.column("text")):
                rows = len(offsets) - 1
                names = [class_of(hashes[offsets[k] : offsets[k + 1]]) for k in range(rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, rows),
                        pa.array(names, pa.int64()),
                        pa.array(np.diff(offsets), pa.int64()),
                    ],
                    ["id", "class", "n"],
                )

    return text.mapInArrow(work, "id long, class long, n long")


def packs(
    fragments: int, hashes: np.ndarray, owner: np.ndarray, names: np.ndarray
) -> pa.RecordBatch:
    """Shingles dealt to their fragments: a row (fragment, shingles, owners, names) for each, with
    the place of an owner among the names."""
    fragment = (hashes % np.uint64(fragments)).astype(np.int64)
    order = np.argsort(fragment, kind="stable")
    edges = np.searchsorted(fragment[order], np.arange(fragments + 1))
    rows: tuple[list, ...] = ([], [], [], [])
    for f in np.flatnonzero(np.diff(edges)).tolist():
        at = order[edges[f] : edges[f + 1]]
        used, place = np.unique(owner[at], return_inverse=True)
        rows[0].append(f)
        rows[1].append((hashes[at] // np.uint64(fragments)).astype("<u8").tobytes())
        rows[2].append(place.astype("<u4").tobytes())
        rows[3].append(names[used].astype("<i8").tobytes())
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)],
        ["fragment", "shingles", "owners", "names"],
    )


PACK = "fragment int, shingles binary, owners binary, names binary"


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(fragment, shingles, names) for each fragment of a sorted partition, one row for each pair
    of a shingle and a class, by shingle, then class, without repetitions."""
    held: list[tuple[bytes, bytes, bytes]] = []
    current = None

    def joined() -> tuple[int, np.ndarray, np.ndarray]:
        shingles = np.frombuffer(b"".join(h[0] for h in held), "<u8")
        names = np.concatenate(
            [np.frombuffer(h[2], "<i8")[np.frombuffer(h[1], "<u4")] for h in held]
        )
        order = np.lexsort((names, shingles))
        shingles, names = shingles[order], names[order]
        new = np.ones(len(names), bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (names[1:] != names[:-1])
        return current, shingles[new], names[new]

    for batch in batches:
        columns = [batch.column(k) for k in range(4)]
        for row in range(batch.num_rows):
            fragment = columns[0][row].as_py()
            if fragment != current:
                if held:
                    yield joined()
                current, held = fragment, []
            held.append(tuple(c[row].as_py() for c in columns[1:]))
    if held:
        yield joined()


def bundled(bundles: int, names: np.ndarray, values: list[bytes]) -> pa.RecordBatch:
    """One row (bundle, names, lengths, values) for each bundle of classes: what a task found out
    about each class, as few rows whatever the number of classes."""
    bundle = (mix(names.view(np.uint64)) % np.uint64(bundles)).astype(np.int64)
    rows: tuple[list, ...] = ([], [], [], [])
    order = np.argsort(bundle, kind="stable")
    edges = np.searchsorted(bundle[order], np.arange(bundles + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        at = order[edges[k] : edges[k + 1]].tolist()
        some = [values[j] for j in at]
        rows[0].append(k)
        rows[1].append(names[at].astype("<i8").tobytes())
        rows[2].append(np.array([len(v) for v in some], "<i8").tobytes())
        rows[3].append(b"".join(some))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)],
        ["bundle", "names", "lengths", "parts"],
    )


BUNDLE = "bundle int, names binary, lengths binary, parts binary"


def unbundled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[list[bytes]]]]:
    """(names, parts of each) for each bundle of a sorted partition."""
    held: dict[int, list[bytes]] = {}
    current = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bundle"] != current:
                if held:
                    yield np.array(list(held), np.int64), list(held.values())
                current, held = row["bundle"], {}
            cuts = np.concatenate([[0], np.cumsum(np.frombuffer(row["lengths"], "<i8"))]).tolist()
            for k, name in enumerate(np.frombuffer(row["names"], "<i8").tolist()):
                held.setdefault(name, []).append(row["parts"][cuts[k] : cuts[k + 1]])
    if held:
        yield np.array(list(held), np.int64), list(held.values())


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and its length."""
    begin = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    return begin, np.diff(np.append(begin, len(sorted_values)))


def shared_counts(text: DataFrame) -> DataFrame:
    """(class, shared): of the shingles that a class sends in step 1, how many are in another."""
    fragments, bundles = 4 * partitions(text.sparkSession), partitions(text.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, offsets in shingle_sets(batch.column("text")):
                n = np.diff(offsets)
                sent = sent_first(n)
                place = np.arange(len(hashes)) - np.repeat(offsets[:-1], n)
                owner = np.repeat(np.arange(len(n)), n)
                names = np.array(
                    [class_of(hashes[offsets[k] : offsets[k + 1]]) for k in range(len(n))], np.int64
                )
                first = np.zeros(len(n), bool)
                first[np.unique(names, return_index=True)[1]] = True
                keep = (place < np.repeat(sent, n)) & first[owner]
                if keep.any():
                    yield packs(fragments, hashes[keep], owner[keep], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[list, list] = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
        for _, shingles, names in unpacked(batches):
            _, size = runs(shingles)
            several = np.repeat(size > 1, size)
            found, n = np.unique(names[several], return_counts=True)
            total[0].append(found)
            total[1].append(n)
        names, place = np.unique(np.concatenate(total[0]), return_inverse=True)
        sums = np.bincount(place, np.concatenate(total[1]), len(names)).astype("<i8")
        yield bundled(bundles, names, [n.tobytes() for n in sums])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, parts in unbundled(batches):
            sums = [int(np.frombuffer(b"".join(p), "<i8").sum()) for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(sums, pa.int64())], ["class", "shared"]
            )

    dealt = text.select("text").mapInArrow(send, PACK)
    dealt = dealt.repartition(partitions(text.sparkSession), "fragment").sortWithinPartitions("fragment")
    return by_bundle(dealt.mapInArrow(count, BUNDLE)).mapInArrow(add, "class long, shared long")


def by_bundle(found: DataFrame) -> DataFrame:
    count = partitions(found.sparkSession)
    return found.repartition(count, "bundle").sortWithinPartitions("bundle")


def sets_of(text: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, n, shingles) of the classes ``wanted`` (class, id of a row that has it)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, offsets in shingle_sets(batch.column("text")):
                own = [hashes[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([class_of(h) for h in own], pa.int64()),
                        pa.array([len(h) for h in own], pa.int64()),
                        pa.array([h.astype("<u8").tobytes() for h in own], pa.binary()),
                    ],
                    ["class", "n", "shingles"],
                )

    ids = write_and_read(wanted.select("id").distinct(), "ids")
    chosen = text.join(ids, text["id"].eqNullSafe(ids["id"]), "left_semi")
    found = chosen.select("text").mapInArrow(work, "class long, n long, shingles binary")
    return found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def ordered(sets: DataFrame) -> DataFrame:
    """(class, n, shingles) with the shingles that several of these classes have, as numbers whose
    order is the global one. Classes with too few of them leave."""
    fragments = partitions(sets.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                own = [np.frombuffer(s, "<u8") for s in part.column("shingles").to_pylist()]
                owner = np.repeat(np.arange(len(own)), [len(o) for o in own])
                yield packs(fragments, np.concatenate(own), owner, part.column("class").to_numpy())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: tuple[list, list] = ([np.zeros(0, np.int64)], [np.zeros(0, np.uint64)])
        for fragment, shingles, names in unpacked(batches):
            _, size = runs(shingles)
            several = np.repeat(size > 1, size)
            power = np.log2(np.repeat(size, size)).astype(np.uint64)
            hashes = shingles * np.uint64(fragments) + np.uint64(fragment)
            every[0].append(names[several])
            every[1].append(((power << np.uint64(58)) | (hashes >> np.uint64(6)))[several])
        names, place = map(np.concatenate, every)
        order = np.argsort(names, kind="stable")
        names, place = names[order], place[order].astype("<u8")
        if len(names):
            begin, _ = runs(names)
            parts = [p.tobytes() for p in np.split(place, begin[1:])]
            yield bundled(fragments, names[begin], parts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, parts in unbundled(batches):
            made = [np.sort(np.frombuffer(b"".join(p), "<u8")).tobytes() for p in parts]
            for a in range(0, len(made), 500):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[a : a + 500], pa.int64()), pa.array(made[a : a + 500], pa.binary())],
                    ["class", "shingles"],
                )

    dealt = sets.select("class", "shingles").mapInArrow(send, PACK)
    dealt = dealt.repartition(partitions(sets.sparkSession), "fragment").sortWithinPartitions("fragment")
    made = by_bundle(dealt.mapInArrow(number, BUNDLE)).mapInArrow(gather, "class long, shingles binary")
    enough = F.expr(f"100 * (length(shingles) div 8) >= {PERCENT} * n")
    return made.join(sets.select("class", "n"), "class").where(enough).select("class", "n", "shingles")


def prefixes(sets: DataFrame) -> DataFrame:
    """(shingle, class, n, score) for the shingles at the beginning of the global order that decide
    whether two classes can link; score tells how common a class's shingles are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                n = part.column("n").to_numpy()
                own = [np.frombuffer(s, "<u8") for s in part.column("shingles").to_pylist()]
                alone = n - np.array([len(o) for o in own])
                size = np.maximum(n - least_common(n) + 1 - alone, 0)
                score = np.array([float((o >> np.uint64(58)).sum()) for o in own]) / n
                own = [o[:k] for o, k in zip(own, size, strict=True)]
                count = np.array([len(o) for o in own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(own).view("<i8"), pa.int64()),
                        pa.array(np.repeat(part.column("class").to_numpy(), count), pa.int64()),
                        pa.array(np.repeat(n, count), pa.int64()),
                        pa.array(np.repeat(score, count), pa.float64()),
                    ],
                    ["shingle", "class", "n", "score"],
                )

    return sets.mapInArrow(work, "shingle long, class long, n long, score double")


def verified(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that link: overlaps of each fragment of the order, summed."""

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = [
                len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
                for x, y in zip(
                    batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(4)), pa.array(common, pa.int64())],
                ["a", "b", "n_a", "n_b", "common"],
            )

    left = fragments.select(F.col("class").alias("a"), "fragment", F.col("shingles").alias("x"))
    right = fragments.select(F.col("class").alias("b"), "fragment", F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, ["b", "fragment"])
    parts = both.select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(
        overlap, "a long, b long, n_a long, n_b long, common long"
    )
    sums = parts.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common"))
    return sums.where(F.expr(f"100 * common >= {PERCENT} * (n_a + n_b - common)")).select("a", "b")


def cut(sets: DataFrame) -> DataFrame:
    """(class, fragment, shingles): each class's part of every fragment of the global order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [])
            for name, raw in zip(
                batch.column("class").to_pylist(), batch.column("shingles").to_pylist(), strict=True
            ):
                own = np.frombuffer(raw, "<u8")
                fragment = (own >> np.uint64(56)).astype(np.int64)
                begin, _ = runs(fragment) if len(own) else (np.zeros(0, np.int64), None)
                for part in np.split(own, begin[1:]) if len(own) else []:
                    rows[0].append(name)
                    rows[1].append(int(part[0] >> np.uint64(56)))
                    rows[2].append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary())],
                ["class", "fragment", "shingles"],
            )

    return sets.select("class", "shingles").mapInArrow(work, "class long, fragment int, shingles binary")


def may_link(n_a: str, n_b: str) -> str:
    """SQL: the sizes of two sets allow a link."""
    return f"100 * least({n_a}, {n_b}) >= {PERCENT} * greatest({n_a}, {n_b})"


def class_components(sets: DataFrame) -> DataFrame:
    """(node, component) for classes that link with another."""
    firsts = write_and_read(prefixes(sets), "prefixes")
    best = firsts.groupBy("shingle").agg(
        F.max(F.struct("score", "class", "n")).alias("l"), F.count("*").alias("k")
    )
    best = best.where("k > 1").select("shingle", "l")
    leaders = firsts.join(best, "shingle").groupBy("class", "n").agg(F.max("l").alias("l"))
    leaders = leaders.select("class", "n", F.col("l.class").alias("leader"), F.col("l.n").alias("n_l"))
    leaders = write_and_read(leaders, "leaders")
    pairs = leaders.where("class <> leader").where(may_link("n", "n_l")).select(
        F.col("class").alias("a"), F.col("leader").alias("b"), F.col("n").alias("n_a"), F.col("n_l").alias("n_b")
    )
    edges = write_and_read(verified(pairs, write_and_read(cut(sets), "fragments")), "links")
    joined = write_and_read(components(edges), "components")
    sizes = joined.groupBy("component").agg(F.count("*").alias("size"))
    placed = leaders.select("class", "leader").join(
        joined.join(sizes, "component").withColumnRenamed("node", "class"), "class", "left"
    )
    lone = F.col("component").isNull()
    alone = placed.where(lone).groupBy("leader").agg(F.count("*").alias("lone_size"))
    placed = placed.join(alone, "leader", "left").select(
        "class",
        lone.alias("lone"),
        F.coalesce("component", "leader").alias("group"),
        F.when(lone, F.col("lone_size")).otherwise(F.col("size")).alias("size"),
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    placed = write_and_read(placed, "placed")
    more = compared(sets, placed, asked_blocks(firsts, placed))
    return components(edges.union(write_and_read(more, "links")))


GROUP = ["lone", "group", "part"]


def asked_blocks(firsts: DataFrame, placed: DataFrame) -> DataFrame:
    """(asker, lone, group, part): the blocks that a class has to be compared with, because they hold
    a class of another component with which it shares a shingle. Of two groups, the classes of the
    smaller one ask."""
    rows = firsts.select("shingle", "class").join(placed, "class")
    several = rows.groupBy("shingle").agg(
        F.min(F.struct("lone", "group")).alias("x"),
        F.max(F.struct("lone", "group")).alias("y"),
        F.count("*").alias("k"),
    )
    several = several.where("k > 1 AND (x <> y OR x.lone)").select("shingle")
    rows = write_and_read(rows.join(several, "shingle", "left_semi"), "mixed")
    met = rows.select("shingle", "size", *GROUP).distinct()
    own = rows.select(
        "shingle",
        F.col("class").alias("asker"),
        F.struct("size", "lone", "group").alias("own_group"),
    )
    both = own.join(met, "shingle")
    other = F.struct("size", "lone", "group")
    asks = (F.col("own_group") < other) | ((F.col("own_group") == other) & F.col("lone"))
    return both.where(asks).select("asker", *GROUP).distinct()


def compared(sets: DataFrame, placed: DataFrame, asked: DataFrame) -> DataFrame:
    """(a, b) of links between askers and members of the blocks they ask; of the links in a block
    as many as join what is linked."""
    asked = write_and_read(asked, "asked")
    wanted = asked.select(*GROUP).distinct()
    members = sets.join(placed.select("class", *GROUP), "class").join(wanted, GROUP, "left_semi")
    askers = sets.join(asked.withColumnRenamed("asker", "class"), "class")
    columns = [*GROUP, "asks", "class", "n", "shingles"]
    rows = members.withColumn("asks", F.lit(False)).select(*columns).union(
        askers.withColumn("asks", F.lit(True)).select(*columns)
    )
    rows = rows.repartition(partitions(sets.sparkSession), *GROUP).sortWithinPartitions(*GROUP, "asks")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, current = None, None
        for batch in batches:
            table = batch.to_pydict()
            edges: list[tuple[int, int]] = []
            for at in range(batch.num_rows):
                key = tuple(table[g][at] for g in GROUP)
                if key != current:
                    edges += block.joins() if block else []
                    block, current = Block(), key
                row = (table["class"][at], table["n"][at], np.frombuffer(table["shingles"][at], "<u8"))
                if table["asks"][at]:
                    edges += block.ask(*row)
                else:
                    block.hold(*row)
            yield edge_batch(edges)
        if block:
            yield edge_batch(block.joins())

    return rows.mapInArrow(work, "a long, b long")


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    flat = np.array(edges, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])


class Block:
    """Classes whose overlap with others is counted by an index of their shingles."""

    def __init__(self) -> None:
        self.names: list[int] = []
        self.sizes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.ready = False

    def hold(self, name: int, size: int, shingles: np.ndarray) -> None:
        self.names.append(name)
        self.sizes.append(size)
        self.sets.append(shingles)

    def _index(self) -> None:
        owner = np.repeat(np.arange(len(self.sets), dtype=np.int32), [len(s) for s in self.sets])
        flat = np.concatenate(self.sets)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        flat = flat[order]
        self.begin, self.length = runs(flat)
        self.shingles = flat[self.begin]
        self.n = np.array(self.sizes, np.int64)
        self.root = np.arange(len(self.sets))
        self.sets.clear()
        self.ready = True

    def ask(self, name: int, size: int, shingles: np.ndarray) -> list[tuple[int, int]]:
        """The link of a class with one of the block; others that it links with are joined."""
        if not self.ready:
            if not self.names:
                return []
            self._index()
        at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
        at = at[self.shingles[at] == shingles]
        length = self.length[at]
        ends = np.cumsum(length)
        if not len(ends):
            return []
        places = np.arange(int(ends[-1])) + np.repeat(self.begin[at] - (ends - length), length)
        common = np.bincount(self.owner[places], minlength=len(self.n))
        linked = np.flatnonzero(100 * common >= PERCENT * (size + self.n - common))
        linked = [k for k in linked.tolist() if self.names[k] != name]
        if not linked:
            return []
        roots = np.unique(self.root[linked])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]
        return [(name, self.names[linked[0]])]

    def joins(self) -> list[tuple[int, int]]:
        """Links, direct or not, among the block's own classes."""
        if not self.ready:
            return []
        return [
            (self.names[k], self.names[r]) for k, r in enumerate(self.root.tolist()) if k != r
        ]


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component) of every row: the size of its set, and the smallest id reachable
    by links, itself included."""
    text = keyed_text(docs, id_col, text_col)
    rows = write_and_read(classes(text), "classes")
    named = rows.where("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    named = write_and_read(named, "classes")
    likely = named.join(shared_counts(text), "class").where("shared >= 1 + floor(n / 4)")
    likely = write_and_read(likely, "likely")
    sets = write_and_read(sets_of(text, likely), "sets")
    joined = write_and_read(class_components(write_and_read(ordered(sets), "ordered")), "components")
    roots = named.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "id", F.coalesce("component", "class").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("id").alias("component"))
    per_class = write_and_read(roots.join(least, "root").select("class", "component"), "components")
    return rows.join(per_class, "class", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component")
    )
