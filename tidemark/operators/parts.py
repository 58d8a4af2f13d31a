"""Multipart ranges of archives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizes import part_size
from tidemark.operators.ordering import last_wins
from tidemark.operators.planning import assign_batches

SIGN_BATCH = 256


def sized_archives(archives: DataFrame) -> DataFrame:
    """Archives with their part size in bytes."""
    return archives.withColumn(
        "part_size_bytes", part_size(F.col("total_bytes"), F.col("requested_mb"))
    )


def part_ranges(archives: DataFrame) -> DataFrame:
    """1-based parts of each archive; the last one is short. Empty archives have none."""
    sized = sized_archives(archives).where(F.col("total_bytes") > 0)
    last = F.call_function("div", F.col("total_bytes") - 1, F.col("part_size_bytes"))
    spread = sized.select(
        "archive_id",
        "total_bytes",
        "part_size_bytes",
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("i"),
    )
    offset = F.col("i") * F.col("part_size_bytes")
    return spread.select(
        "archive_id",
        (F.col("i") + 1).alias("part_number"),
        offset.alias("offset"),
        F.least("part_size_bytes", F.col("total_bytes") - offset).alias("size_bytes"),
    )


def empty_archives(archives: DataFrame) -> DataFrame:
    """Archives that cannot be cut into parts."""
    return archives.where(F.coalesce("total_bytes", F.lit(0)) <= 0).select(
        "archive_id", F.lit("archive is empty").alias("message")
    )


def sign_batches(parts: DataFrame, size: int = SIGN_BATCH) -> DataFrame:
    """Parts grouped for signing. Part numbers are consecutive, so the batch follows from them."""
    size = max(1, int(size))
    batch = F.call_function("div", F.col("part_number") - 1, F.lit(size))
    return parts.withColumn("batch_id", batch)


def number_parts(parts: DataFrame, size: int = SIGN_BATCH) -> DataFrame:
    """The same for parts whose numbers may have gaps."""
    return assign_batches(parts, size, ["archive_id"], [F.col("part_number")])


def assemble_parts(parts: DataFrame, uploaded: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Planned parts with the tag of their upload; a NULL ``etag`` marks a missing part.

    Of repeated uploads of a part the last counts, by ``ordinal``. Uploads of unplanned part numbers
    are dropped. Order by ``part_number`` when writing out.
    """
    keys = ["archive_id", "part_number"]
    tags = last_wins(uploaded.select(*keys, "etag", ordinal), keys, ordinal, ["etag"]).drop(ordinal)
    return parts.join(tags, ["archive_id", "part_number"], "left").select(
        "archive_id", "part_number", "etag", "size_bytes"
    )


def missing_parts(assembled: DataFrame) -> DataFrame:
    return assembled.where(F.col("etag").isNull()).select("archive_id", "part_number")


def multipart_summary(archives: DataFrame) -> DataFrame:
    """Part size, part count and bytes per archive, straight from the sizes: counting the parts
    would only explode and shuffle what one division tells."""
    sized = sized_archives(archives).where(F.col("total_bytes") > 0)
    count = F.call_function("div", F.col("total_bytes") - 1, F.col("part_size_bytes")) + 1
    return sized.select("archive_id", "part_size_bytes", count.alias("part_count"), "total_bytes")


def summarise_parts(parts: DataFrame) -> DataFrame:
    """The same from stored parts."""
    return parts.groupBy("archive_id").agg(
        F.max("size_bytes").alias("part_size_bytes"),
        F.count(F.lit(1)).alias("part_count"),
        F.sum("size_bytes").alias("total_bytes"),
    )
