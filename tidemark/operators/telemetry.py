"""Timings and progress of transfers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizes import mib, mib_rate
from tidemark.operators.ordering import running_totals

FIRST_TARGET = 512


def timing_summary(events: DataFrame, keys: Sequence[str] = ("name",)) -> DataFrame:
    """Count, durations, files, bytes and throughput per name.

    The summed duration is rounded first; average and throughput use the rounded value.
    """
    duration = F.greatest(F.lit(0.0), F.col("duration_sec").cast("double"))
    sums = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.sum(duration), 6).alias("duration_sec"),
        F.round(F.max(duration), 6).alias("max_duration_sec"),
        F.sum("file_count").alias("file_count"),
        F.sum("byte_count").alias("byte_count"),
    )
    total = F.col("duration_sec")
    measured = (F.col("byte_count") > 0) & (total > 0)
    return sums.select(
        *keys,
        "count",
        "duration_sec",
        F.round(total / F.col("count"), 6).alias("avg_duration_sec"),
        "max_duration_sec",
        "file_count",
        "byte_count",
        F.round(mib(F.col("byte_count")), 3).alias("mib"),
        F.when(measured, F.round(mib(F.col("byte_count")) / total, 3)).alias("throughput_mibps"),
    )


def _seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6


def first_n_accepted(events: DataFrame, target: int = FIRST_TARGET) -> DataFrame:
    """When each run had ``target`` files accepted, counted from its first event; runs that did
    not get there report their total, runs that accepted nothing are left out."""
    accepted = events.select(
        "run_id",
        "ts",
        "event_id",
        F.greatest(F.lit(0), F.col("file_count")).cast("bigint").alias("accepted"),
    )
    running = running_totals(
        accepted,
        ["run_id"],
        [F.col("ts"), F.col("event_id")],
        {"total": "accepted"},
        {"started": "ts"},
    )
    crossed = running.where(
        (F.col("total") >= target) & (F.col("total") - F.col("accepted") < target)
    ).select(
        "run_id",
        F.round(_seconds_between(F.col("started"), F.col("ts")), 3).alias("elapsed_sec"),
        F.col("total").alias("at_target"),
    )
    totals = accepted.groupBy("run_id").agg(F.sum("accepted").alias("total"))
    return (
        totals.where(F.col("total") > 0)
        .join(crossed, "run_id", "left")
        .select(
            "run_id",
            F.lit(target).cast("bigint").alias("target_files"),
            F.col("at_target").isNotNull().alias("reached"),
            "elapsed_sec",
            F.coalesce("at_target", "total").alias("accepted_files"),
        )
    )


def transfer_progress(events: DataFrame, reset_per_batch: bool = True) -> DataFrame:
    """Files, bytes and rate so far at each event: per batch for folders, per run for archives."""
    group = ["run_id", "batch_id"] if reset_per_batch else ["run_id"]
    running = running_totals(
        events.select("run_id", "batch_id", "event_id", "ts", "file_count", "byte_count"),
        group,
        [F.col("ts"), F.col("event_id")],
        {"done_files": "file_count", "done_bytes": "byte_count"},
        {"started": "ts"},
    )
    elapsed = _seconds_between(F.col("started"), F.col("ts"))
    return running.select(
        "run_id",
        "batch_id",
        "event_id",
        "done_files",
        "done_bytes",
        F.round(mib(F.col("done_bytes")), 1).alias("done_mib"),
        mib_rate(F.col("done_bytes"), elapsed).alias("mib_per_sec"),
    )
