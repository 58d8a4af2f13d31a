"""Ordered operators against brute force, with one group holding most rows."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering, parts, planning, telemetry


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    keys = rng.sample(range(10**6), 6000)
    return [("hot" if rng.random() < 0.7 else f"g{rng.randint(0, 40)}", k, k % 9 - 2) for k in keys]


@pytest.fixture()
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, k bigint, v bigint").repartition(13)


def groups(rows):
    out = defaultdict(list)
    for g, k, v in rows:
        out[g].append((k, v))
    return {g: sorted(members) for g, members in out.items()}


def test_number_rows(df, rows):
    got = {(r.g, r.k): r.row_index for r in ordering.number_rows(df, ["g"], [F.col("k")]).collect()}
    want = {(g, k): i for g, m in groups(rows).items() for i, (k, _) in enumerate(m)}
    assert got == want


def test_running_totals(df, rows):
    out = ordering.running_totals(df, ["g"], [F.col("k")], {"total": "v"}, {"start": "k"})
    got = {(r.g, r.k): (r.total, r.start) for r in out.collect()}
    for g, members in groups(rows).items():
        total = 0
        for k, v in members:
            total += v
            assert got[g, k] == (total, members[0][0])


@pytest.mark.parametrize("k", [1, 7, 1001, 1500])
def test_top_k(df, rows, k):
    out = ordering.top_k(df, ["g"], [F.col("k")], k)
    got = {(r.g, r.k): r.rank for r in out.collect()}
    want = {(g, m[0]): i + 1 for g, ms in groups(rows).items() for i, m in enumerate(ms[:k])}
    assert got == want


def test_lookup_meets_hot_key_once(spark, df, rows):
    names = sorted({g for g, _, _ in rows})[1:]
    dim = spark.createDataFrame([(g, i) for i, g in enumerate(names)], "g string, i int")
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            inner = ordering.lookup(df, dim, "g", "inner").collect()
            left = ordering.lookup(df, dim, "g").collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert sorted((r.g, r.k) for r in left) == sorted((g, k) for g, k, _ in rows)
        assert sorted((r.g, r.k) for r in inner) == sorted((g, k) for g, k, _ in rows if g in names)


def test_no_window_gathers_a_group(spark, df):
    """The only windows over whole groups run after each salt kept k rows."""
    plan = ordering.top_k(df, ["g"], [F.col("k")], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_last_wins_and_distinct(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 2, ""), ("b", 1, "x"), ("b", 2, "x")],
        "k string, o int, v string",
    )
    assert sorted(map(tuple, ordering.last_wins(df, ["k"], "o").collect())) == [
        ("a", 3, "y"),
        ("b", 2, "x"),
    ]
    got = ordering.ordered_distinct(df, ["k"], "v", "o").collect()
    assert sorted(map(tuple, got)) == [("a", "x", 1), ("a", "y", 3), ("b", "x", 1)]


def test_batches_and_parts(spark):
    files = spark.createDataFrame(
        [("d", p) for p in ("a-b", "a/b", "a", "c")], "dataset_id string, relative_path string"
    )
    got = planning.assign_batches(files, 2).orderBy("row_index").collect()
    assert [(r.relative_path, r.batch_id) for r in got] == [("a", 0), ("a/b", 0), ("a-b", 1), ("c", 1)]
    size = 5 * 1024 * 1024
    archives = spark.createDataFrame(
        [(1, 2 * size, 1), (2, 2 * size + 1, 1), (3, 0, 1)],
        "archive_id bigint, total_bytes bigint, requested_mb int",
    )
    ranges = parts.part_ranges(archives).orderBy("archive_id", "part_number").collect()
    assert [tuple(r) for r in ranges] == [
        (1, 1, 0, size),
        (1, 2, size, size),
        (2, 1, 0, size),
        (2, 2, size, size),
        (2, 3, 2 * size, 1),
    ]
    assert [r.archive_id for r in parts.empty_archives(archives).collect()] == [3]


def test_first_n_counts_negatives_as_zero(spark):
    events = spark.createDataFrame(
        [(1, i, i, n) for i, n in enumerate([300, -50, 211, 1, 9])] + [(2, 9, 0, 5), (3, 8, 0, 0)],
        "run_id bigint, event_id bigint, sec bigint, file_count bigint",
    ).withColumn("ts", F.timestamp_seconds("sec"))
    got = {r.run_id: r for r in telemetry.first_n_accepted(events).collect()}
    assert (got[1].reached, got[1].elapsed_sec, got[1].accepted_files) == (True, 3.0, 512)
    assert (got[2].reached, got[2].elapsed_sec, got[2].accepted_files) == (False, None, 5)
    assert 3 not in got


def test_nothing_runs_before_an_action(spark, df):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("numbering", "numbering")
    try:
        numbered = ordering.number_rows(df, ["g"], [F.col("k")])
        totals = ordering.running_totals(df, ["g"], [F.col("k")], {"total": "v"}, {"start": "k"})
        assert len(tracker.getJobIdsForGroup("numbering")) == 0
        assert numbered.count() == totals.count() == df.count()
        assert len(tracker.getJobIdsForGroup("numbering")) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_numbering_of_hot_null_and_repeated_groups(spark):
    rows = [(g, k) for g, n in ((None, 700), ("a", 40), ("b", 1), ("", 300)) for k in [None, *range(n - 1)]]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    got = ordering.number_rows(df, ["g"], [F.col("k")]).collect()
    assert len(got) == len(rows)
    assert all(r.row_index == (0 if r.k is None else r.k + 1) for r in got)
    assert ordering.number_rows(df.limit(0), ["g"], [F.col("k")]).collect() == []
    whole = ordering.number_rows(df.where("g = 'a'"), [], [F.col("k")]).collect()
    assert sorted(r.row_index for r in whole) == list(range(40))


def test_hot_group_is_cut_into_ranges(spark):
    """No task of the numbering has most of a group."""
    df = spark.range(20000).select(F.lit("hot").alias("g"), F.col("id").alias("k"))
    ranged, _ = ordering._ranged(df, ["g"], [F.col("k")])
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 0.3 * 20000
