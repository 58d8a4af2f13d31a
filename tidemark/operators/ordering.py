"""Ordered work inside groups of any size.

A window over one group is one task. Groups here may hold a third of all rows, so a group is cut into
ranges of its order: positions and running sums are computed per range and shifted by the totals of the
ranges before. The cuts are a bounded sample of the keys, drawn by the query itself; nothing runs before an
action, and rows go through one shuffle, with the totals of the ranges beside them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys drawn for each range.
SAMPLE = 32


def _cuts(df: DataFrame, key: Column, ranges: int) -> Column:
    """About ``ranges`` ascending keys: of those with the smallest hashes every ``SAMPLE``-th. At most
    ``SAMPLE * ranges`` rows are looked at together."""
    drawn = df.select(key.alias("k"), F.xxhash64(key, F.lit(3)).alias("h")).orderBy("h", "k").limit(SAMPLE * ranges)
    every = F.array_sort(F.collect_set("k"))
    step = F.greatest(F.lit(1), F.ceil(F.size(every) / ranges).cast("int"))
    return drawn.agg(F.filter(every, lambda _, i: (i + 1) % step == 0).alias("cuts")).scalar()


def _ranged(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    """Rows with ``_range``, ascending in (group, order), and the names of their order columns.

    ``order`` must be unique inside a group, else equal rows may swap places between attempts.
    """
    ranges = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    names = [f"_order_{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(names, order)))
    # Nulls sort first in keys, as they do in rows.
    key = F.struct(*group, *names)
    found = keyed.withColumns({"_cuts": _cuts(keyed, key, ranges), "_range": F.lit(0)})
    # Binary search for the number of cuts that are not above the key, one column for each step.
    for bit in reversed(range(ranges.bit_length())):
        reached = F.coalesce(F.get("_cuts", F.col("_range") + (2**bit - 1)) <= key, F.lit(False))
        found = found.withColumn("_range", F.col("_range") + F.when(reached, 2**bit).otherwise(0))
    return found.drop("_cuts"), names


def _totals_before(
    ranged: DataFrame,
    group: Sequence[str],
    names: Sequence[str],
    sums: Mapping[str, Column],
    firsts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per (group, range): the group's totals in earlier ranges and the group's first values. At most
    one row per group and range."""
    firsts = firsts or {}
    cells = ranged.groupBy(*group, "_range").agg(
        *[c.alias(f"_before_{n}") for n, c in sums.items()],
        *[F.min_by(c, F.struct(*names)).alias(f"_start_{n}") for n, c in firsts.items()],
    )
    in_order = Window.partitionBy(*group).orderBy("_range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(
        *[F.col(g).alias(f"_group_{i}") for i, g in enumerate(group)],
        F.col("_range").alias("_of"),
        *[
            F.coalesce(F.sum(f"_before_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}")
            for n in sums
        ],
        *[F.first(f"_start_{n}").over(in_order).alias(f"_start_{n}") for n in firsts],
    )


def _beside(ranged: DataFrame, before: DataFrame, group: Sequence[str]) -> DataFrame:
    same = [ranged[g].eqNullSafe(before[f"_group_{i}"]) for i, g in enumerate(group)]
    return ranged.join(before, [*same, ranged["_range"] == before["_of"]])


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "row_index"
) -> DataFrame:
    """0-based position of each row in its group."""
    ranged, names = _ranged(df, group, order)
    before = _totals_before(ranged, group, names, {"rows": F.count(F.lit(1))})
    inside = Window.partitionBy(*group, "_range").orderBy(*names)
    local = ranged.withColumn("_inside", F.row_number().over(inside).cast("bigint") - 1)
    numbered = _beside(local, before, group).withColumn(name, F.col("_inside") + F.col("_before_rows"))
    return numbered.select(*df.columns, name)


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, str],
    firsts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Running sum, own row included, of column ``sums[name]`` as ``name`` for each entry, and the
    group's first value of column ``firsts[name]`` as ``name``."""
    firsts = firsts or {}
    ranged, names = _ranged(df, group, order)
    before = _totals_before(ranged, group, names, {n: F.sum(c) for n, c in sums.items()}, firsts)
    inside = (
        Window.partitionBy(*group, "_range")
        .orderBy(*names)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = ranged.withColumns({f"_inside_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    return _beside(local, before, group).select(
        *df.columns,
        *[(F.col(f"_inside_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums],
        *[F.col(f"_start_{n}").alias(n) for n in firsts],
    )


def top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group with their 1-based rank, exact for groups of any size.

    A group is first ranked in as many parts as there are shuffle partitions; what passes is ranked
    again. The rank filters are right whether or not Spark prunes rows before its shuffles.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(parts)))
    per_salt = Window.partitionBy(*group, "_salt").orderBy(*order)
    per_group = Window.partitionBy(*group).orderBy(*order)
    few = salted.withColumn("_rank", F.row_number().over(per_salt)).where(F.col("_rank") <= k)
    few = few.drop("_salt", "_rank")
    return few.withColumn(name, F.row_number().over(per_group)).where(F.col(name) <= k)


def last_wins(
    df: DataFrame, keys: Sequence[str], ordinal: str | Column, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the highest ordinal per key. An aggregate, so hot keys shrink before
    the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(F.col(ordinal) if isinstance(ordinal, str) else ordinal, *tie_break)
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_kept"))
    return kept.select(*keys, "_kept.*").select(*df.columns)


def ordered_distinct(df: DataFrame, keys: Sequence[str], value: str, ordinal: str) -> DataFrame:
    """Drop blank values, keep the first occurrence of each value with its ordinal."""
    present = df.where(F.col(value).isNotNull() & (F.col(value) != ""))
    return present.groupBy(*keys, value).agg(F.min(ordinal).alias(ordinal))


def name_order(df: DataFrame, name: str = "name", position: str = "position") -> DataFrame:
    """Rows with their 0-based place when sorted by name, in code-point order."""
    return number_rows(df, [], [F.col(name)], position)


def lookup(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a table holding one row per ``key`` to facts in which one key may be hot.

    Spark broadcasts the dimension when its size allows; else a hot key's partition of facts is
    split at run time, which only needs that nothing above the join wants the key together.
    """
    return fact.join(dim, key, how)
