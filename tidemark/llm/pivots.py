"""Embedding near-duplicates by a pivot-permutation index.

About ``2 * sqrt(n)`` vectors, at least ``LEAST_PIVOTS``, are drawn as pivots (the bounded sample the
index is fitted on; every vector is indexed). A vector is described by its ``NEAREST`` pivots in order
of nearness and stands in the inverted list of each, per label. Vectors that meet in a list and share
at least ``SHARED`` pivots are compared by cosine in double precision; a pair counts in the list of
the first pivot they share, so once. Long lists are cut into blocks, and every two blocks of a list
meet in a group of their own.

Equal vectors of a label are indexed once and counted as often as they occur. Vectors that are null,
empty, zero, or hold null or non-finite components, and those without a label, link with nothing;
nor do vectors of different lengths. Repeated ids are answered row by row. Ties in nearness go to
the earlier pivot. An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, partitions
from tidemark.shared import write_and_read

LEAST_PIVOTS, MOST_PIVOTS = 32, 4096
NEAREST, SHARED = 8, 2
#: Vectors of a list that are compared with each other, or with another block, in one group.
BLOCK = 256


def keyed_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, key, vector) of every row; key and vector (unit length, doubles) are null where
    a row can't link. Equal keys are equal labels and vectors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units = [], []
            for label, vector in zip(
                batch.column("label").to_pylist(), batch.column("vector"), strict=True
            ):
                unit = None
                if label is not None and vector.is_valid and not vector.values.null_count:
                    raw = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if len(raw) and np.isfinite(raw).all() and raw.any():
                        raw = raw / np.abs(raw).max()
                        unit = (raw / np.sqrt(raw @ raw) + 0.0).astype("<f8").tobytes()
                units.append(unit)
                keys.append(
                    None
                    if unit is None
                    else hashlib.blake2b(f"{label}\0".encode() + unit, digest_size=16).digest()
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array(keys, pa.binary()),
                    pa.array(units, pa.binary()),
                ],
                ["id", "label", "key", "vector"],
            )

    chosen = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    return chosen.mapInArrow(work, "id long, label string, key binary, vector binary")


def draw_pivots(classes: DataFrame, count: int) -> list[np.ndarray]:
    """The vectors of ``count`` classes with the smallest hashes, grouped by length."""
    drawn = classes.orderBy(F.xxhash64("key", F.lit(5)), "key").limit(count).select("vector").collect()
    by_length: dict[int, list[np.ndarray]] = {}
    for row in drawn:
        vector = np.frombuffer(row["vector"], "<f8")
        by_length.setdefault(len(vector), []).append(vector)
    return [np.stack(v) for v in by_length.values()]


def index(classes: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """Rows (label, pivot, class, copies, nearest, vector): each class in the lists of its pivots."""
    of_length = {p.shape[1]: p for p in pivots}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                vectors = [np.frombuffer(v, "<f8") for v in part.column("vector").to_pylist()]
                row, pivot, nearest = [], [], []
                for length in sorted({len(v) for v in vectors}):
                    rows = [k for k, v in enumerate(vectors) if len(v) == length]
                    refs = of_length.get(length, np.zeros((1, length)))
                    sims = np.stack([vectors[k] for k in rows]) @ refs.T
                    m = min(NEAREST, len(refs))
                    best = np.argsort(-sims, axis=1, kind="stable")[:, :m].astype("<i4")
                    for k, own in zip(rows, best, strict=True):
                        row += [k] * m
                        pivot += own.tolist()
                        nearest += [own.tobytes()] * m
                taken = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("label"),
                        pa.array(pivot, pa.int32()),
                        taken.column("class"),
                        taken.column("copies"),
                        pa.array(nearest, pa.binary()),
                        taken.column("vector"),
                    ],
                    ["label", "pivot", "class", "copies", "nearest", "vector"],
                )

    return classes.select("label", "class", "copies", "vector").mapInArrow(
        work,
        "label string, pivot int, class long, copies long, nearest binary, vector binary",
    )


def compare(
    left: list[tuple], right: list[tuple] | None, pivot: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in left + right) that link and have ``pivot`` as the first one they share."""
    both = left + (right or [])
    lengths = np.array([len(r[3]) for r in both])
    pairs = [np.zeros((2, 0), np.int64)]
    for length in np.unique(lengths):
        a = np.flatnonzero(lengths[: len(left)] == length)
        b = a if right is None else np.flatnonzero(lengths[len(left) :] == length) + len(left)
        if not len(a) or not len(b):
            continue
        x = np.frombuffer(b"".join(both[k][3] for k in a), "<f8").reshape(len(a), -1)
        y = np.frombuffer(b"".join(both[k][3] for k in b), "<f8").reshape(len(b), -1)
        i, j = np.nonzero(x @ y.T >= least)
        i, j = a[i], b[j]
        if right is None:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        lists = {k: np.frombuffer(both[k][2], "<i4") for k in {*i.tolist(), *j.tolist()}}
        wide = max(len(v) for v in lists.values())
        table = np.full((len(both), wide), -1, np.int32)
        for k, v in lists.items():
            table[k, : len(v)] = v
        same = (table[i][:, :, None] == table[j][:, None, :]) & (table[i][:, :, None] >= 0)
        shared = same.any(axis=2)
        enough = shared.sum(axis=1) >= min(SHARED, wide)
        lowest = np.where(shared, table[i], np.iinfo(np.int32).max).min(axis=1)
        good = enough & (lowest == pivot)
        pairs.append(np.stack([i[good], j[good]]))
    i, j = np.concatenate(pairs, axis=1)
    return i, j


def links(index_rows: DataFrame, least: float) -> DataFrame:
    """(class, n, root) per class and group: how many vectors it links with there, and the smallest
    class that it is joined to by links of that group."""
    sizes = index_rows.groupBy("label", "pivot").agg(F.count("*").alias("size"))
    sizes = sizes.where("size > 1").select(
        "label", "pivot", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    )
    rows = index_rows.join(write_and_read(sizes, "sizes"), ["label", "pivot"])
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    rows = rows.select(
        "label",
        "pivot",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "class",
        "copies",
        "nearest",
        "vector",
    )
    group = ["label", "pivot", "low", "high"]
    dealt = rows.repartition(partitions(index_rows.sparkSession), *group)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members = None, ([], [])
        for batch in batches:
            table = batch.to_pydict()
            for at in range(batch.num_rows):
                key = tuple(table[g][at] for g in group)
                if key != current:
                    if current is not None and (made := finish(current, *members)) is not None:
                        yield made
                    current, members = key, ([], [])
                members[table["own"][at] != key[2]].append(
                    tuple(table[c][at] for c in ("class", "copies", "nearest", "vector"))
                )
        if current is not None and (made := finish(current, *members)) is not None:
            yield made

    def finish(key: tuple, left: list[tuple], right: list[tuple]) -> pa.RecordBatch | None:
        i, j = compare(left, right if key[2] != key[3] else None, key[1], least)
        if not len(i):
            return None
        both = left + right
        classes = np.array([r[0] for r in both], np.int64)
        copies = np.array([r[1] for r in both], np.int64)
        n = np.bincount(i, copies[j], len(both)) + np.bincount(j, copies[i], len(both))
        root = classes.copy()
        while True:
            low = np.minimum(root[i], root[j])
            after = root.copy()
            np.minimum.at(after, i, low)
            np.minimum.at(after, j, low)
            if np.array_equal(after, root):
                break
            root = after
        at = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(classes[at]), pa.array(n[at].astype(np.int64)), pa.array(root[at])],
            ["class", "n", "root"],
        )

    return dealt.sortWithinPartitions(*group).mapInArrow(work, "class long, n long, root long")


def near_duplicates(
    rows: DataFrame,
    least: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, n_links, component) of every row: the other vectors linked directly, and the smallest
    id reachable by links."""
    vectors = write_and_read(keyed_vectors(rows, id_col, vector_col, label_col), "vectors")
    classes = (
        vectors.where("key is not null")
        .groupBy("key")
        .agg(
            F.min("id").alias("least"),
            F.count("*").alias("copies"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
    )
    # Ids may be repeated or missing; a class is known by a number that the written table fixes.
    classes = write_and_read(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    count = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(2 * math.sqrt(classes.count()))))
    rows_of_index = write_and_read(index(classes, draw_pivots(classes, count)), "pivot_index")
    found = write_and_read(links(rows_of_index, least), "links")
    totals = found.groupBy("class").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.select("key", "class", "copies", "least")
        .join(totals, "class", "left")
        .join(joined.withColumnRenamed("node", "class"), "class", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("root"),
            "least",
        )
    )
    per_class = write_and_read(per_class, "classes")
    names = per_class.groupBy("root").agg(F.min("least").alias("component"))
    per_class = per_class.drop("least").join(names, "root").drop("root")
    per_class = write_and_read(per_class, "classes")
    return vectors.select("id", "key").join(per_class, "key", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    )
