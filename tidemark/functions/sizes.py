"""Sizes, rates and missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB = 1024 * 1024
# Multipart limits.
MIN_PART_MIB = 5
AUTO_PART_MIB = 64
MAX_PARTS = 9000


def part_size(total_bytes: Column, requested_mib: Column) -> Column:
    """Bytes per part. Automatic sizing keeps an archive within the part limit."""
    asked = F.coalesce(requested_mib, F.lit(0)).cast("bigint") * MIB
    smallest = F.lit(MIN_PART_MIB * MIB).cast("bigint")
    limit = F.expr(f"{MAX_PARTS}L")
    filled = F.call_function("div", total_bytes + (MAX_PARTS - 1), limit)
    return F.when(asked > 0, F.greatest(smallest, asked)).otherwise(
        F.greatest(F.lit(AUTO_PART_MIB * MIB).cast("bigint"), filled)
    )


def mib(bytes_: Column) -> Column:
    return bytes_.cast("double") / float(MIB)


def mib_rate(bytes_: Column, seconds: Column) -> Column:
    """MiB per second to two decimals; elapsed time counts as at least a millisecond."""
    return F.round(mib(bytes_) / F.greatest(F.lit(0.001), seconds.cast("double")), 2)


def fill_missing_text(value: Column, other: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.nullif(other, F.lit("")))


def fill_missing_number(value: Column, other: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit(0)), F.nullif(other, F.lit(0)))
