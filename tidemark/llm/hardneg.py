"""Hard negatives of anchors: rows of other labels that score within a window below a positive.

Anchors meet candidates in tiles of whole numbers. A tile's scores are one product by Strassen's
recursion: both sides are padded with zeros to even sizes, seven products of halves replace eight, and
all additions are exact integers (int64 where no sum can leave it, Python integers elsewhere). The best
positives of an anchor, and the best negatives of each of its windows, are bounded heaps; heaps of tiles
merge in a task as tiles pass, and those of tasks merge in Spark.

Two passes: first anchors meet the rows of their own label, dealt by hash into shards of about
``SHARD_ROWS`` however many rows a label holds; then they meet the shards of all rows, where rows of
their own label are masked.

Components become ``floor(scale * x)`` of the double x. Higher scores come first, then smaller ids.
Rows without id or label, and those whose vector is null or holds null or non-finite components, take no
part; vectors of different lengths don't meet; empty vectors score 0. Repeated rows are anchors,
positives and negatives as often as they occur; only an anchor's own row is none of its positives. A
score that a long can't hold counts as the nearest long. An empty table gives an empty table. Other
columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tiles
from tidemark.llm.common import partitions
from tidemark.shared import write_and_read

SHARD_ROWS, TILE, ANCHORS, ASKS = 16384, 2048, 512, 8192
#: Sides up to this long are multiplied directly.
DIRECT = 32
#: Not a score: those are clipped above it.
MASKED = tiles.LOWEST - 1


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two integer matrices."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= DIRECT:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    whole = np.empty((2 * i, 2 * l), p1.dtype)
    whole[:i, :l] = p1 + p4 - p5 + p7
    whole[:i, l:] = p3 + p5
    whole[i:, :l] = p2 + p4
    whole[i:, l:] = p1 - p2 + p3 + p6
    return whole[:m, :n]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and of ``b``, as int64."""
    most = tiles.magnitude(a) * tiles.magnitude(b) * max(a.shape[1], 1)
    kind = np.int64 if most < 2**62 and max(tiles.magnitude(a), tiles.magnitude(b)) < 2**62 else object
    return tiles.clipped(strassen(a.astype(kind), b.astype(kind).T))


@dataclass
class Heaps:
    """For every row the best (score, id) seen, best first; MASKED where there are fewer."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, rows: int, size: int) -> Heaps:
        return cls(np.full((rows, size), MASKED, np.int64), np.zeros((rows, size), np.int64))

    def merge(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Add candidates, for every row some; the heaps keep their size."""
        size = self.scores.shape[1]
        both, names = np.hstack([self.scores, scores]), np.hstack([self.ids, ids])
        order = np.lexsort((names, ~both), axis=1)[:, :size]
        self.scores = np.take_along_axis(both, order, axis=1)
        self.ids = np.take_along_axis(names, order, axis=1)


@dataclass
class Shard:
    """Candidates in order of their ids."""

    points: np.ndarray
    ids: np.ndarray
    marks: np.ndarray
    labels: np.ndarray


def rows_of(rows: DataFrame, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (id, label, vector) that take part, with how often they occur."""
    chosen = rows.select(
        F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    there = F.col("id").isNotNull() & F.col("label").isNotNull()
    counted = chosen.where(there & tiles.whole_vector(F.col("vector")))
    counted = counted.groupBy("id", "label", "vector").agg(F.count("*").alias("copies"))
    mark = F.xxhash64("id", "label", "vector")
    return counted.select("id", "label", "vector", "copies", mark.alias("mark"), F.size("vector").alias("length"))


def shard_of(rows: Column, mark: Column, least: int) -> tuple[Column, Column]:
    """The shard of a row among ``rows``, and how many there are: ``least`` where each still has some
    hundred rows."""
    shards = F.greatest(F.ceil(rows / SHARD_ROWS), F.least(F.lit(least), F.ceil(rows / 512)))
    return F.pmod(mark, shards), shards


def prepare(scale: int, most: int):
    def work(held: pa.Table) -> Shard:
        copies = np.minimum(tiles.integers(held["copies"].combine_chunks()), most)
        ids = np.repeat(tiles.integers(held["id"].combine_chunks()), copies)
        order = np.argsort(ids, kind="stable")
        points = np.repeat(tiles.matrix(held["vector"].combine_chunks(), scale), copies, axis=0)
        marks = np.repeat(tiles.integers(held["mark"].combine_chunks()), copies)
        labels = np.repeat(tiles.integers(held["label"].combine_chunks()), copies)
        return Shard(points[order], ids[order], marks[order], labels[order])

    return work


def best_columns(scores: np.ndarray, size: int) -> np.ndarray:
    """Columns of the ``size`` highest scores of each row, ties to the earlier column."""
    return np.argsort(~scores, axis=1, kind="stable")[:, :size]


def positive_rows(scale: int, size: int):
    def work(shard: Shard, piece: pa.RecordBatch) -> pa.RecordBatch:
        outs = []
        for start in range(0, piece.num_rows, ANCHORS):
            part = piece.slice(start, ANCHORS)
            own_ids, own_marks = tiles.integers(part.column("id")), tiles.integers(part.column("mark"))
            anchors = tiles.matrix(part.column("vector"), scale)
            heaps = Heaps.empty(len(own_ids), size)
            seen = np.zeros(len(own_ids), bool)
            for first in range(0, len(shard.ids), TILE):
                ids, marks = shard.ids[first : first + TILE], shard.marks[first : first + TILE]
                scores = products(anchors, shard.points[first : first + TILE])
                own = (ids == own_ids[:, None]) & (marks == own_marks[:, None])
                at = own.argmax(axis=1)
                skip = own.any(axis=1) & ~seen
                scores[np.flatnonzero(skip), at[skip]] = MASKED
                seen |= skip
                best = best_columns(scores, size)
                heaps.merge(np.take_along_axis(scores, best, axis=1), ids[best])
            row, rank = np.nonzero(heaps.scores != MASKED)
            outs.append((own_ids[row], own_marks[row], heaps.ids[row, rank], heaps.scores[row, rank]))
        columns = [np.concatenate(c) for c in zip(*outs, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["anchor_id", "mark", "positive_id", "positive_score"]
        )

    return work


def window_rows(scale: int, size: int, least: int, most: int):
    """Negatives between ``least`` and ``most`` hundredths of the positive's score."""

    def work(shard: Shard, piece: pa.RecordBatch) -> pa.RecordBatch:
        outs = []
        for start in range(0, piece.num_rows, ANCHORS):
            part = piece.slice(start, ANCHORS)
            own_ids, own_marks = tiles.integers(part.column("id")), tiles.integers(part.column("mark"))
            own_labels = tiles.integers(part.column("label"))
            anchors = tiles.matrix(part.column("vector"), scale)
            positives = part.column("positive_scores").to_pylist()
            wide = max(len(p) for p in positives)
            # A window that is not there ends before it begins.
            low = np.full((len(positives), wide), tiles.HIGHEST, np.int64)
            high = np.full((len(positives), wide), tiles.LOWEST, np.int64)
            for k, own in enumerate(positives):
                low[k, : len(own)] = [max(-(-least * p // 100), tiles.LOWEST) for p in own]
                high[k, : len(own)] = [min(most * p // 100, tiles.HIGHEST) for p in own]
            heaps = [Heaps.empty(len(own_ids), size) for _ in range(wide)]
            for first in range(0, len(shard.ids), TILE):
                ids = shard.ids[first : first + TILE]
                scores = products(anchors, shard.points[first : first + TILE])
                scores[shard.labels[first : first + TILE] == own_labels[:, None]] = MASKED
                order = best_columns(scores, len(ids))
                falling = np.take_along_axis(scores, order, axis=1)
                for w in range(wide):
                    begin = (falling > high[:, w, None]).sum(axis=1)
                    at = begin[:, None] + np.arange(size)
                    inside = at < len(ids)
                    at = np.minimum(at, len(ids) - 1)
                    near = np.take_along_axis(falling, at, axis=1)
                    near = np.where(inside & (near >= low[:, w, None]), near, MASKED)
                    heaps[w].merge(near, ids[np.take_along_axis(order, at, axis=1)])
            for w, heap in enumerate(heaps):
                row, rank = np.nonzero(heap.scores != MASKED)
                window = np.full(len(row), w)
                outs.append((own_ids[row], own_marks[row], window, heap.ids[row, rank], heap.scores[row, rank]))
        columns = [np.concatenate(c) for c in zip(*outs, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            ["anchor_id", "mark", "place", "negative_id", "negative_score"],
        )

    return work


def mine(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``is_anchor`` is a
    condition on column ``id``; ``label`` an expression over ``rows``."""
    spark = rows.sparkSession
    kept = write_and_read(rows_of(rows, label, id_col, vector_col), "candidates")
    anchors = kept.where(is_anchor)
    tasks = 2 * partitions(spark)

    sizes = kept.groupBy("length", "label").agg(
        F.count("*").alias("rows"), F.ceil(F.count_if(is_anchor) / ASKS).cast("int").alias("salts")
    )
    sizes = sizes.where("salts > 0")
    keys = ["length", "label", "part", "salt"]
    part, parts = shard_of(F.col("rows"), F.col("mark"), tasks)
    to_salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    to_parts = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    salt = F.pmod(F.xxhash64("id", "mark"), "salts").cast("int")
    fields = ["id", "mark", "copies", "vector", *keys]
    same = tiles.meet(
        kept.join(sizes, ["length", "label"]).withColumn("part", part).withColumn("salt", to_salts).select(fields),
        anchors.join(sizes, ["length", "label"]).withColumn("part", to_parts).withColumn("salt", salt).select(fields),
        keys,
        prepare(scale, positives + 1),
        positive_rows(scale, positives),
        "anchor_id long, mark long, positive_id long, positive_score long",
    )
    order = Window.partitionBy("anchor_id", "mark").orderBy(F.col("positive_score").desc(), "positive_id")
    found = same.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    found = write_and_read(found, "positives")

    lists = found.groupBy(F.col("anchor_id").alias("id"), "mark").agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_score")))["positive_score"].alias("positive_scores")
    )
    asking = anchors.join(lists, ["id", "mark"])
    sizes = kept.groupBy("length").agg(
        F.count("*").alias("rows"), F.ceil(F.count_if(is_anchor) / ASKS).cast("int").alias("salts")
    )
    sizes = sizes.where("salts > 0")
    keys = ["length", "part", "salt"]
    fields = ["id", "mark", "label", "copies", "vector", *keys]
    other = tiles.meet(
        kept.join(sizes, "length").withColumn("part", part).withColumn("salt", to_salts).select(fields),
        asking.join(sizes, "length").withColumn("part", to_parts).withColumn("salt", salt).select(*fields, "positive_scores"),
        keys,
        prepare(scale, negatives),
        window_rows(scale, negatives, least, most),
        "anchor_id long, mark long, place long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("anchor_id", "mark", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    other = other.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    copies = anchors.select(F.col("id").alias("anchor_id"), "mark", "copies")
    mined = found.join(other, ["anchor_id", "mark", "place"]).join(copies, ["anchor_id", "mark"])
    each = mined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
