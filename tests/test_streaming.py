"""Streams over several micro-batches end where the batch operators do."""

from __future__ import annotations

import os
import random
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import telemetry
from tidemark.shared import new_path
from tidemark.streaming import feeds, keyed, sinks

EVENT = "run_id bigint, event_id bigint, sec bigint, file_count bigint, byte_count bigint"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Five files, one micro-batch each, in time order."""
    rng = random.Random(5)
    path = str(tmp_path_factory.mktemp("events"))
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), i, i * 7, rng.randint(-3, 20), i) for i in range(400)]
    for start in range(0, 400, 80):
        df = spark.createDataFrame(rows[start : start + 80], EVENT)
        df.withColumn("ts", F.timestamp_seconds("sec")).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return feeds.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def drained(df, folder=None, checkpoint=None, timers=False):
    """Run a stream over what is there; its folder, and the query that has ended."""
    spark = df.sparkSession
    folder = folder or new_path(spark, "feeds")
    query = sinks.start(df, folder, checkpoint, timers=timers)
    query.awaitTermination()
    return folder, query


def test_first_n_over_batches(spark, events):
    checkpoint = new_path(spark, "streams")
    feed = lambda: feeds.stream_first_n(stream(spark, events), 200)
    folder, _ = drained(feed(), None, checkpoint, timers=True)
    want = telemetry.first_n_accepted(spark.read.parquet(events), 200).where("reached")
    assert want.count() > 1
    assert same(want, sinks.read_rows(spark, folder, feeds.MILESTONES))
    drained(feed(), folder, checkpoint, timers=True)  # a restart says nothing again
    assert same(want, sinks.read_rows(spark, folder, feeds.MILESTONES))


def test_first_n_writes_what_a_batch_touches(spark, tmp_path):
    """A micro-batch updates the state of its own runs, however many others there are."""
    schema = "run_id bigint, event_id bigint, file_count bigint, ts timestamp"
    lands = [range(300), range(3), range(5)]
    for k, runs in enumerate(lands):
        rows = [(r, k, 10, None) for r in runs]
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.lit(100 + k)))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path))
    feed = feeds.stream_first_n(feeds.file_stream(spark, str(tmp_path), schema, max_files=1), 30)
    folder, query = drained(feed, timers=True)
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    assert updated[0] >= 300 and all(n <= 2 * len(runs) for n, runs in zip(updated[1:], lands[1:]))
    assert {r.run_id for r in sinks.read_rows(spark, folder, feeds.MILESTONES).collect()} == {0, 1, 2}


class CountedState:
    """A processor's state of one key that counts the calls to it."""

    def __init__(self):
        self.entries, self.value, self.calls = {}, None, []

    def getMapState(self, name, key_schema, schema, ttl):
        self.ttl = ttl
        return self

    def getValueState(self, name, schema):
        return self

    def called(self, name, result=None):
        self.calls.append(name)
        return result

    def iterator(self):
        return self.called("iterator", iter(list(self.entries.items())))

    def getValue(self, key):
        return self.called("getValue", self.entries.get(key))

    def updateValue(self, key, value):
        self.called("updateValue", self.entries.update({key: value}))

    def get(self):
        return self.called("get", self.value)

    def update(self, value):
        self.value = self.called("update", value)


class Clock:
    now = 1_000_000

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_runs_of_a_bucket_share_calls_to_the_state():
    """The state is asked once for all runs of a micro-batch, or for those few alone; a run that has its
    files isn't written again before it would be forgotten."""
    state, clock, runs = CountedState(), Clock(), keyed.FirstN(100, 64_000)
    runs.init(state)
    rng, seen, got = np.random.default_rng(4), [], []

    def land(of, rows):
        run = np.sort(np.concatenate([of, rng.choice(of, rows)]))
        us = 10**9 * (len(seen) + 1) + rng.integers(0, 10**8, len(run))
        made = {"run_id": run, "us": us, "event_id": np.arange(len(run)), "files": rng.integers(0, 30, len(run))}
        seen.append(pd.DataFrame(made))
        parts = np.array_split(rng.permutation(len(run)), 7)
        chunks = [pd.DataFrame([{n: v[part] for n, v in made.items()} for part in parts[a:b]]) for a, b in ((0, 3), (3, 7))]
        state.calls.clear()
        for out in runs.handleInputRows((5,), iter(chunks), clock):
            got.extend(out.itertuples(index=False, name=None))
        return {name: state.calls.count(name) for name in state.calls}

    everyone = np.arange(400)
    assert land(everyone, 1200) == {"get": 1, "update": 1, "updateValue": 400}
    for _ in range(6):
        calls = land(everyone, 1200)
        assert calls.pop("updateValue", 0) <= 400 and calls == {"get": 1, "iterator": 1}
    assert len(got) == 400 and land(everyone, 1200) == {"get": 1, "iterator": 1}
    assert land(np.arange(3), 50) == {"get": 1, "getValue": 3}
    clock.now += 1000
    assert land(np.arange(3), 50) == {"get": 1, "getValue": 3, "updateValue": 3} and state.ttl == 65_000

    ordered = pd.concat(seen).sort_values(["run_id", "us", "event_id"])
    ordered["total"] = ordered.groupby("run_id")["files"].cumsum()
    first = ordered.groupby("run_id")["us"].min()
    want = ordered[ordered["total"] >= 100].groupby("run_id").first()
    for run_id, target, reached, elapsed, accepted in got:
        row = want.loc[run_id]
        assert (target, reached, accepted) == (100, True, row["total"])
        assert elapsed == (row["us"] - first[run_id] + 500) // 1000 / 1000


def test_rows_without_a_run_are_a_run(spark, tmp_path):
    """A null run is not run 0, also in one task's rows, and large numbers of runs stay whole."""
    schema = "run_id bigint, event_id bigint, file_count bigint, ts timestamp"
    names = [None, 0, 2**53 + 1, 2**53, -1]
    for k in range(3):
        rows = [(run, None if n == 3 else n, 5 + i, None) for i, run in enumerate(names) for n in range(4)]
        df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.lit(100 + 3 * k)))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path))
    feed = feeds.stream_first_n(feeds.file_stream(spark, str(tmp_path), schema, max_files=1), 40)
    folder, _ = drained(feed, timers=True)
    got = {r.run_id: (r.elapsed_sec, r.accepted_files) for r in sinks.read_rows(spark, folder, feeds.MILESTONES).collect()}
    assert got == {None: (3.0, 40), 0: (3.0, 42), 2**53 + 1: (3.0, 42), 2**53: (3.0, 40), -1: (3.0, 45)}


def test_thinned_rows_decide_the_same():
    """What a task drops of a hot run can't change when the run reaches its target."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, None]), rng.randint(0, 500), k, rng.randint(0, 9)) for k in range(4000)]
    names = ["run_id", "us", "event_id", "files"]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[k : k + 700]]) for k in range(0, 4000, 700)
    ]
    thin = [tuple(r.values()) for b in keyed.thin_files(40)(iter(batches)) for r in b.to_pylist()]
    assert len(thin) < 0.1 * len(rows)

    def crossing(some, run):
        total, first = 0, None
        for _, us, event, files in sorted((r for r in some if r[0] == run), key=lambda r: r[1:3]):
            first = us if first is None else first
            total += files
            if total >= 40:
                return first, us, event, total

    assert all(crossing(rows, run) == crossing(thin, run) is not None for run in (1, None))


def test_progress_over_batches(spark, events):
    checkpoint = new_path(spark, "streams")
    progress = feeds.stream_progress(stream(spark, events), "10 minutes", "5 minutes")
    folder, query = drained(progress, None, checkpoint)
    whole = feeds.stream_progress(spark.read.parquet(events), "10 minutes", "5 minutes")
    closed = sinks.read_rows(spark, folder, feeds.PROGRESS).count()
    assert 0 < closed < whole.count()  # closed intervals are written once, open ones are state
    assert same(whole, feeds.latest_progress(spark, folder, checkpoint))


def land_polls(spark, path, polls):
    schema = "project_id string, import_id string, status string, sec bigint"
    for batch in polls:
        df = spark.createDataFrame([("p", *r) for r in batch], schema)
        df = df.select("project_id", "import_id", "status", F.timestamp_seconds("sec").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def test_status_by_the_streams_clock(spark, tmp_path):
    path = str(tmp_path)
    landed = land_polls(
        spark,
        path,
        [
            [("done", "running", 1000), ("silent", "queued", 1001), ("again", "failed", 1001)],
            [("done", " Succeeded", 1005), ("again", "succeeded", 1007), ("last", "running", 1030)],
            [("done", "failed", 1050), ("last", None, 1055), ("overdue", "running", 1056)],
            [("overdue", "done", 1120), ("open", "running", 1130)],
        ],
    )
    checkpoint = new_path(spark, "streams")
    feed = lambda: feeds.stream_import_status(stream(spark, path), 60, "0 seconds", 1e6)
    folder, query = drained(feed(), None, checkpoint)
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 4
    outcomes = sinks.read_rows(spark, folder, feeds.OUTCOMES)
    want = {
        "done": (" Succeeded", "success", 5.0),
        "again": ("failed", "failed", 0.0),
        "silent": (None, "timed_out", 60.0),
        "last": (None, "timed_out", 60.0),
        "overdue": (None, "timed_out", 60.0),
    }
    got = outcomes.collect()
    assert {r.import_id: (r.status, r.outcome, r.waited_sec) for r in got} == want and len(got) == len(want)
    assert [tuple(r) for r in feeds.open_imports(landed, outcomes).collect()] == [("p", "open", "running", "pending", 0.0)]
    drained(feed(), folder, checkpoint)  # a restart from the checkpoint repeats nothing
    assert sinks.read_rows(spark, folder, feeds.OUTCOMES).count() == len(want)


def test_silent_import_times_out_by_itself(spark, tmp_path):
    """Nobody polls and nobody reads: the row appears when the deadline passes, once."""
    path, folder, checkpoint = str(tmp_path), new_path(spark, "feeds"), new_path(spark, "streams")
    land_polls(spark, path, [[("silent", "running", 5), ("done", "ready", 6)]])
    feed = lambda: feeds.stream_import_status(stream(spark, path), 2)

    def ended(least):
        until = time.monotonic() + 60
        while sinks.read_rows(spark, folder, feeds.OUTCOMES).count() < least and time.monotonic() < until:
            time.sleep(0.5)
        return sorted((r.import_id, r.outcome) for r in sinks.read_rows(spark, folder, feeds.OUTCOMES).collect())

    running = sinks.start(feed(), folder, checkpoint, every="200 milliseconds", timers=True)
    try:
        assert ended(2) == [("done", "success"), ("silent", "timed_out")]
    finally:
        running.stop()
    land_polls(spark, path, [[("silent", "ready", 9), ("new", "failed", 9)]])
    running = sinks.start(feed(), folder, checkpoint, every="200 milliseconds", timers=True)
    try:
        assert ended(3) == [("done", "success"), ("new", "failed"), ("silent", "timed_out")]
    finally:
        running.stop()


def test_file_state_over_batches(spark, events):
    source = spark.read.parquet(events)
    shaped = lambda df: df.select(
        F.lit("p").alias("project_id"),
        F.lit("i").alias("import_id"),
        (F.col("event_id") % 30).cast("string").alias("relative_path"),
        F.when(F.col("event_id") > 90, F.col("file_count") > 10).alias("uploaded"),
        (F.col("file_count") > 18).alias("streamed"),
        "ts",
        "event_id",
        F.lit(None).cast("string").alias("object_key"),
        F.lit(None).cast("string").alias("sha256"),
        F.col("byte_count").alias("size_bytes"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
    )
    checkpoint = new_path(spark, "streams")
    states = feeds.stream_file_state(shaped(stream(spark, events)))
    feeds.start_file_state(states, checkpoint).awaitTermination()
    want = shaped(source).groupBy("relative_path").agg(
        F.coalesce(F.bool_or("uploaded"), F.lit(False)).alias("uploaded"),
        F.bool_or("streamed").alias("streamed"),
        F.max_by("size_bytes", "event_id").alias("size_bytes"),
    )
    assert same(want, feeds.current_file_state(spark, checkpoint))


def test_what_many_batches_leave_is_bounded(spark, tmp_path):
    """More than a hundred micro-batches leave as many folders and state files as Spark is told to keep."""
    schema = "project_id string, import_id string, relative_path string, uploaded boolean, streamed boolean, " + (
        "ts timestamp, event_id bigint, object_key string, sha256 string, size_bytes bigint, width int, height int"
    )
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    row = ("p", "i", "a", True, None, None, 1, "k", None, 1, None, None)
    spark.createDataFrame([row] * 200, schema).repartition(200).write.parquet(path)
    keep = {"spark.sql.streaming.minBatchesToRetain": "5", "spark.sql.shuffle.partitions": "1"}
    with sinks.settings(spark, keep | {"spark.sql.streaming.stateStore.maintenanceInterval": "1s"}):
        states = feeds.stream_file_state(feeds.file_stream(spark, path, schema, max_files=1))
        query = feeds.start_file_state(states, checkpoint)
        query.awaitTermination()
    assert query.lastProgress.batchId > 100
    folders = sum(len(names) for _, names, _ in os.walk(checkpoint))
    logged = len(os.listdir(f"{checkpoint}/commits"))
    assert folders < 20 and logged < 30
    assert feeds.current_file_state(spark, checkpoint).count() == 1


def test_stream_runs_until_stopped(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "dataset_id string, relative_path string"
    spark.createDataFrame([("d", "a")], schema).write.parquet(source)
    folder = new_path(spark, "feeds")
    flushes = feeds.micro_batches(feeds.file_stream(spark, source, schema, max_files=1), 2, wait_sec=1)
    running = sinks.start(flushes, folder, every="100 milliseconds", timers=True)
    try:
        for name in "bc":
            spark.createDataFrame([("d", name)], schema).write.mode("append").parquet(source)
        until = time.monotonic() + 60
        while time.monotonic() < until:
            out = sinks.read_rows(spark, folder, feeds.FLUSHES).collect()
            if sum(len(r.entries) for r in out) == 3:
                break
            time.sleep(0.5)
        assert running.isActive
    finally:
        running.stop()
    assert sorted(e for r in out for e in r.entries) == list("abc")
    assert {r.reason for r in out} <= {"full", "waited"} and "waited" in {r.reason for r in out}


def test_new_files_appear_once(spark, tmp_path):
    schema = "dataset_id string, relative_path string"
    for names in ("ab", "bc", "abcd"):
        rows = [("d", n) for n in names]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path))
    fresh = feeds.stream_new_files(feeds.file_stream(spark, str(tmp_path), schema, max_files=1))
    folder, _ = drained(fresh)
    got = [r.relative_path for r in sinks.read_rows(spark, folder, schema).collect()]
    assert sorted(got) == list("abcd")


def test_seen_files_are_forgotten_after_the_horizon(spark, tmp_path):
    """Twenty micro-batches of new names: the state stays as large as one horizon's files."""
    schema = "dataset_id string, relative_path string, seen timestamp"
    for k in range(20):
        rows = [("d", f"{k}-{n}", None) for n in range(10)] + [("d", f"{k}-3", None)] * (1 + (k > 0))
        rows += [("d", f"{k - 1}-5", None)] * (k > 0)
        df = spark.createDataFrame(rows, schema).withColumn("seen", F.timestamp_seconds(F.lit(1000 + 60 * k)))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path))
    source = feeds.file_stream(spark, str(tmp_path), schema, max_files=1)
    folder, query = drained(feeds.stream_new_files(source, "2 minutes", "seen"))
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.numInputRows]
    assert len(held) == 20 and max(held) <= 60 and max(held[10:]) <= max(held[4:10])
    got = [r.relative_path for r in sinks.read_rows(spark, folder, schema).collect()]
    assert len(got) == len(set(got)) == 200


def test_flushes_carry_over(spark, tmp_path):
    """Five micro-batches of 300 files: two full flushes and, at the end, a short one."""
    schema, source = "dataset_id string, relative_path string", str(tmp_path)
    for k in range(5):
        rows = [("d", f"{k}-{n:03d}") for n in range(300)] + [(None, f"{k}")]
        if k == 4:
            rows += [("d", None)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream_ = feeds.file_stream(spark, source, schema, max_files=1)
    folder, query = drained(
        feeds.micro_batches(stream_, wait_sec=3600, finished=F.col("relative_path").isNull()), timers=True
    )
    assert sum(p.numInputRows > 0 for p in query.recentProgress) == 5
    out = [r for r in sinks.read_rows(spark, folder, feeds.FLUSHES).collect() if r.dataset_id == "d"]
    assert sorted((len(r.entries), r.reason) for r in out) == [(476, "finished"), (512, "full"), (512, "full")]
    assert len({e for r in out for e in r.entries}) == 1500 and len({r.flush_id for r in out}) == 3


def test_a_hot_dataset_is_flushed_by_many_tasks(spark, tmp_path):
    schema, source = "dataset_id string, relative_path string", str(tmp_path)
    rows = spark.range(8 * 2000).select(F.lit("d").alias("dataset_id"), F.col("id").cast("string").alias("relative_path"))
    rows.repartition(8).write.mode("append").parquet(source)
    folder, _ = drained(feeds.micro_batches(feeds.file_stream(spark, source, schema), 100, 3600), timers=True)
    out = sinks.read_rows(spark, folder, feeds.FLUSHES).collect()
    assert {len(r.entries) for r in out} == {100} and len(out) >= 8 * 2000 // 100 - 1


def test_a_part_is_a_micro_batch_however_many_files_it_has(spark):
    from tidemark.plans import streaming_queries

    source, folder, checkpoint = (new_path(spark, kind) for kind in ("arrivals", "feeds", "streams"))
    parts = [spark.range(100 * k, 100 * k + 50 + k).repartition(files) for k, files in enumerate((1, 4, 2, 3))]
    sizes = []

    def start():
        query = sinks.start(feeds.file_stream(spark, source, "id bigint"), folder, checkpoint)
        query.awaitTermination()
        sizes.append([p.numInputRows for p in query.recentProgress if p.numInputRows])
        return query

    streaming_queries._drain([[(part, source)] for part in parts], start)
    assert sizes == [[50], [51], [52], [53]]


def test_a_task_holds_few_entries_of_many_datasets(monkeypatch):
    """Datasets smaller than a flush: what a task holds, and hands on at once, doesn't grow with its rows."""

    class Task:
        def partitionId(self):
            return 3

    monkeypatch.setattr(keyed, "TaskContext", type("Context", (), {"get": staticmethod(Task)}))
    monkeypatch.setattr(keyed, "HELD", 1000)
    names = ["dataset_id", "entry", "finished"]
    rows = [(f"d{k // 7}" if k % 3 else "hot", f"{k}", k % 50 == 0) for k in range(20_000)]
    batches = [
        pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[a : a + 500]]) for a in range(0, len(rows), 500)
    ]
    made = list(keyed.blocks_of(100)(iter(batches)))
    assert max(sum(map(len, b.column("entries").to_pylist())) for b in made) < 2000
    blocks = [b for batch in made for b in batch.to_pylist()]
    assert sorted((b["dataset_id"], e) for b in blocks for e in b["entries"]) == sorted(r[:2] for r in rows)
    assert all(b["lane"] == 0 or len(b["entries"]) == 100 for b in blocks)
    assert {b["dataset_id"] for b in blocks if b["finished"]} == {r[0] for r in rows if r[2]}
