"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of the MD5 of their ids, are cut into blocks. Weights are
whole numbers w that add up to a period R; a source gets w of every R slots. Its block i may start
at slot floor(i * R / w) (release) and must have run by slot ceil((i + 1) * R / w) (deadline); in
every slot the released block with the earliest deadline runs. As the weights fill all slots, every
block meets its window, so at any slot a source has had its share to within less than one block.
The schedule repeats after a period: one period is computed, and every block looked up in it.

``mixed`` is true up to the slot where the first source has no block left; beyond it the mix would
miss its target weights. All rows come back, with their slot, mixed or not.

Null source is a source of its own. Repeated rows and ids stay, in the same or neighbouring blocks.
Null ids count as empty text for the order. An empty table gives an empty table. A source without a
weight is never scheduled: its slot is null and it isn't mixed. Columns of the caller keep their names
and values; names that begin with an underscore are the operator's own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.shared import write_and_read

#: Documents in a block; slots that a period has about; exponent that tempers natural sizes.
BLOCK, RESOLUTION, TEMPER = 16, 1000, 0.7
#: Slots of a period for each source at least; levels of the slot tree that share a shuffle.
PER_SOURCE, INNER = 10, 10
#: Rows that are numbered together, about.
GROUP = 256


def numbered(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """``docs`` with _source and _number, the place of a row in its source from 0.

    Rows are numbered in groups of about ``GROUP`` by the first digits of the hash. The sizes of the
    groups are added up in two steps, by the first half of those digits and then inside each, so no
    source and no long list of groups is ever in one place.
    """
    total = docs.count()
    digits = max(0, math.ceil(math.log(max(total, 1) / GROUP, 16)))
    code = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        "*",
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("_source"),
        code.alias("_code"),
        F.substring(code, 1, digits).alias("_group"),
    )
    sizes = rows.groupBy("_source", "_group").agg(F.count("*").alias("_size"))
    sizes = sizes.withColumn("_part", F.substring("_group", 1, digits // 2))
    parts = sizes.groupBy("_source", "_part").agg(F.sum("_size").alias("_size"))
    parts = parts.select("_source", "_part", _sum_before(["_source"], "_part").alias("_first"))
    sizes = sizes.select(
        "_source", "_part", "_group", _sum_before(["_source", "_part"], "_group").alias("_then")
    )
    sizes = sizes.join(parts, ["_source", "_part"]).select(
        "_source", "_group", (F.col("_first") + F.col("_then")).alias("_before")
    )
    inside = Window.partitionBy("_source", "_group").orderBy("_code", id_col)
    rows = rows.withColumn("_place", F.row_number().over(inside) - 1)
    rows = rows.join(sizes, ["_source", "_group"])
    return rows.withColumn("_number", F.col("_before") + F.col("_place")).drop(
        "_code", "_group", "_before", "_place"
    )


def _sum_before(keys: list[str], order: str) -> Column:
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_size").over(earlier), F.lit(0))


def tempered(sizes: DataFrame, exponent: float = TEMPER, resolution: int = RESOLUTION) -> DataFrame:
    """(_source, w): whole weights in proportion to a power of the sizes, 1 at least. They add up to
    about ``resolution``, or to ``PER_SOURCE`` times the number of sources if that is more."""
    power = F.pow("n", F.lit(exponent))
    whole = sizes.agg(F.sum(power).alias("total"), F.count("*").alias("many")).first()
    share = power / F.lit(whole["total"])
    weight = F.round(share * max(resolution, PER_SOURCE * whole["many"]))
    return sizes.select("_source", F.greatest(F.lit(1), weight).cast("long").alias("w"))


def schedule(weights: DataFrame) -> DataFrame:
    """(_source, w, period, i, offset): the slot in the period of each source's block i, by
    earliest deadline first, of equal deadlines the smaller source.

    The slots are the leaves of a binary tree. Going up, each node knows which of the blocks
    released inside it run inside it if no others are there: those of its left half, and of what the
    left half leaves over and the right half runs, as many with the earliest deadlines as the right
    half has slots. Going down, the blocks that run in a node are dealt to its halves by the same
    rule, until each has a slot. Every level ranks all blocks of the period once; up to ``2**INNER``
    slots the levels share one shuffle.
    """
    weights = weights.where("w > 0")
    period = weights.agg(F.sum("w")).first()[0] or 0
    height = max(0, period - 1).bit_length()
    low = min(height, INNER)
    size, i = F.lit(period).cast("long"), F.col("i")
    jobs = weights.select(
        "_source", "w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("w") - 1)).alias("i")
    )
    jobs = jobs.withColumns(
        {
            "release": F.expr(f"i * {period} div w"),
            "deadline": F.expr(f"((i + 1) * {period} + w - 1) div w"),
        }
    )
    jobs = jobs.withColumn("part", F.shiftright("release", low)).repartition("part")
    first = F.row_number().over(_earliest("part", "release")) == 1
    jobs = jobs.withColumn("runs", F.array(first))
    for level in range(height):
        inner = level < low
        jobs = jobs.withColumn("node", F.shiftright("release", level + 1))
        right = F.shiftright("release", level) % 2 == 1
        jobs = jobs.withColumn("asks", right == F.col("runs")[level])
        place = F.row_number().over(_earliest(*(["part"] if inner else []), "node", "asks"))
        runs = F.when(F.col("asks"), place <= 2**level).otherwise(~right)
        jobs = jobs.withColumn("runs", F.concat("runs", F.array(runs)))
    if height > low:
        jobs = write_and_read(jobs.drop("node", "asks", "part"), "released")
    jobs = jobs.withColumn("node", F.lit(0).cast("long"))
    for level in reversed(range(height)):
        inner = level < low
        if level == low - 1:
            jobs = jobs.withColumn("part", F.col("node")).repartition("part")
        half, left = F.shiftright("release", level), F.col("node") * 2
        jobs = jobs.withColumn("asks", (half < left) | ((half == left) & F.col("runs")[level]))
        place = F.row_number().over(_earliest(*(["part"] if inner else []), "node", "asks"))
        jobs = jobs.withColumn("node", left + F.when(F.col("asks") & (place <= 2**level), 0).otherwise(1))
    return jobs.select("_source", "w", size.alias("period"), i, F.col("node").alias("offset"))


def _earliest(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("deadline", "_source")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    block: int = BLOCK,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """All rows and columns of ``docs`` with _block, _release, _deadline, _slot, _number and _mixed.

    ``weights`` has (source, w) with whole w > 0; by default the sizes, tempered. The schedule has a
    row for each slot of one period, whose length is the sum of the weights.
    """
    rows = write_and_read(numbered(docs, id_col, source_col), "numbered")
    sizes = rows.groupBy("_source").agg(F.count("*").alias("n"))
    if weights is None:
        weights = tempered(sizes)
    else:
        name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
        weights = weights.select(name.alias("_source"), F.col("w").cast("long").alias("w"))
    weights = write_and_read(weights, "weights")
    plan = write_and_read(schedule(weights), "schedule").select(
        "_source",
        F.col("w").alias("_w"),
        F.col("period").alias("_period"),
        F.col("i").alias("_i"),
        F.col("offset").alias("_offset"),
    )
    lengths = plan.where("_i = 0").select("_source", "_w", "_period")
    ends = lengths.join(sizes, "_source", "left").select(
        "_source", "_w", "_period", F.ceil(F.coalesce("n", F.lit(0)) / block).alias("_block")
    )
    ends = ends.withColumn("_i", F.col("_block") % F.col("_w"))
    horizon = ends.join(plan.select("_source", "_i", "_offset"), ["_source", "_i"]).agg(F.min(_slot())).first()[0]
    rows = rows.withColumn("_block", F.floor(F.col("_number") / block))
    rows = rows.join(lengths, "_source", "left")
    rows = rows.withColumn("_i", F.col("_block") % F.col("_w"))
    rows = rows.join(plan.select("_source", "_i", "_offset"), ["_source", "_i"], "left")
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "_block",
        F.floor(F.col("_block") * F.col("_period") / F.col("_w")).alias("_release"),
        F.ceil((F.col("_block") + 1) * F.col("_period") / F.col("_w")).alias("_deadline"),
        _slot().alias("_slot"),
        "_number",
        F.coalesce(_slot() < F.lit(horizon), F.lit(False)).alias("_mixed"),
    )


def _slot() -> Column:
    return F.floor(F.col("_block") / F.col("_w")) * F.col("_period") + F.col("_offset")
