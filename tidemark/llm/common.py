"""What several operators share: the input columns, Arrow helpers, components of a graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import write_and_read


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (id, text): whatever other columns are called, they can't clash. Null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and where each row begins (and all end)."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]]
    return flat, starts.astype(np.int64) - int(starts[0])


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes; a longer row is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pack_lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest reachable.

    Large-star and small-star rounds: each node's neighbours move to its smallest neighbour, first
    the larger ones, then the smaller. Every step is a minimum per key, summed before the shuffle,
    and a join that Spark may split where a node has very many neighbours. Each round is written,
    so a lost executor costs a reread. The rounds grow with the logarithm of a component's width.
    """
    current = write_and_read(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = write_and_read(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        after = write_and_read(small.where("a > b").distinct())
        if _fingerprint(after) == _fingerprint(current):
            break
        current = after
    stars = current.groupBy("a").agg(F.min("b").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.select(F.col("a").alias("node"), "component").union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
