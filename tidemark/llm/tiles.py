"""Stated queries against the rows of bounded shards: exact whole numbers and the meeting of both.

Rows of a shard and the queries that ask it reach one task, sorted so that the rows come first; the
queries then stream past what was made of the rows. Only one shard is held at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions

HIGHEST, LOWEST = 2**63 - 1, -(2**63) + 1


def whole_vector(vector: Column) -> Column:
    """True where an array of doubles is there and all its components are finite numbers."""
    return F.coalesce(
        F.forall(
            vector,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        ),
        F.lit(False),
    )


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: int64, or Python integers where that might not hold them."""
    if not values.size or float(np.abs(values).max()) * scale < 2.0**52:
        return np.floor(values * scale).astype(np.int64)
    exact = [int(v) * scale if abs(v) >= 2.0**52 else int(np.floor(v * scale)) for v in values.flat]
    return np.array(exact, dtype=object).reshape(values.shape)


def magnitude(values: np.ndarray) -> int:
    return int(np.abs(values).max()) if values.size else 0


def clipped(scores: np.ndarray) -> np.ndarray:
    """Scores as int64; what that can't hold becomes the nearest it can."""
    if scores.dtype == np.int64:
        return scores
    if scores.dtype == object:
        return np.array(
            [min(max(int(s), LOWEST), HIGHEST) for s in scores.flat], dtype=np.int64
        ).reshape(scores.shape)
    return scores.astype(np.int64)


def matrix(column: pa.Array, scale: int) -> np.ndarray:
    """Rows of a list column without nulls, all of one length, as whole numbers."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return scaled(flat.reshape(len(column), -1), scale)


def integers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def runs(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Slices of sorted batches with equal ``keys`` (integers without nulls)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([integers(batch.column(k)) for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for first, last in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield tuple(values[:, first].tolist()), batch.slice(int(first), int(last - first))


def meet(
    rows: DataFrame,
    asks: DataFrame,
    keys: list[str],
    prepare: Callable[[pa.Table], object],
    answer: Callable[[object, pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """``answer(prepare(rows of a key), asks of that key)`` for every key that has both.

    ``rows`` and ``asks`` hold the integer ``keys``. A key's rows are held by one task at a time and
    must be few; its asks are not held.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, made = None, [], None
        for (*key, side), piece in runs(batches, [*keys, "side"]):
            if key != current:
                current, held, made = key, [], None
            if side == 0:
                held.append(piece)
            elif held or made is not None:
                if made is None:
                    made, held = prepare(pa.Table.from_batches(held).combine_chunks()), []
                yield answer(made, piece)

    both = rows.withColumn("side", F.lit(0)).unionByName(
        asks.withColumn("side", F.lit(1)), allowMissingColumns=True
    )
    dealt = both.repartition(partitions(rows.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys, "side").mapInArrow(work, schema)
