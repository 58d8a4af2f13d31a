"""Spans of regular expressions in text, with SQL functions only.

Spark gives the matches of a pattern but not their places. Cutting the text at the matches gives
what lies between them; the lengths of both, added up, are the places, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,stop:bigint,hit:string>"
#: Matches that are placed together.
PART = 64


def find_spans(text: Column, pattern: str) -> Column:
    """All matches from left to right without overlap, as array<struct<start, stop, hit>>: code
    points, stop exclusive. The pattern must not match the empty string. Texts without a match are
    looked at once."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(
        gaps, hits, lambda g, h: F.struct(F.length(g).cast("long").alias("g"), h.alias("h"))
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["g"]
        end = begin + F.length(x["h"])
        span = F.struct(begin.alias("start"), end.alias("stop"), x["h"].alias("hit"))
        return F.when(
            x["h"].isNotNull(),
            F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans")),
        ).otherwise(acc)

    def add_part(acc: Column, part: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), none.alias("spans"))
        folded = F.aggregate(part, begin, step)
        grown = lambda f: F.struct(
            f["at"].alias("at"), F.concat(acc["parts"], F.array(f["spans"])).alias("parts")
        )
        return F.transform(F.array(folded), grown)[0]

    def fold(both: Column) -> Column:
        # Each step copies what it has so far: short parts keep the copies short.
        parts = F.transform(
            F.sequence(F.lit(0), F.call_function("div", F.size(both) - 1, F.lit(PART)).cast("int")),
            lambda k: F.slice(both, k * PART + 1, F.lit(PART)),
        )
        start = F.struct(
            F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("parts")
        )
        return F.aggregate(parts, start, add_part, lambda acc: F.flatten(acc["parts"]))

    # The lambda binds the matches, which else would be found anew for every part.
    folded = F.transform(F.array(both), fold)[0]
    return F.when(F.regexp_like(text, F.lit(pattern)), folded).otherwise(none)


def named(spans: Column, kind: str, order: int) -> Column:
    """The same spans with their kind and its place in the order of kinds."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("kind_order"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            s["hit"].alias("hit"),
        ),
    )


def written(spans: Column) -> Column:
    """kind:start:end, joined with commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ","
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
