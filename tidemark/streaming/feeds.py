"""Continuous feeds: new files, progress, import status, milestones, file state and flushes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.sizes import mib, mib_rate
from tidemark.functions.status import import_status_class
from tidemark.operators.telemetry import FIRST_TARGET
from tidemark.streaming import keyed
from tidemark.streaming.sinks import read_rows, start, start_state, state_rows

FLUSH_SIZE = 512
WEEK_SEC = 7 * 86400
#: Keys are dealt into so many buckets where one call of Python per bucket, not per key, is to be made.
BUCKETS = 1024
#: Rows without a number come after those with one.
LAST = 2**63 - 1


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_new_files(
    stream: DataFrame, horizon: str = "7 days", seen_at: str | None = None
) -> DataFrame:
    """Manifest rows not seen within ``horizon``: a file is remembered for that long after it was first
    seen and then forgotten, so the state stays as large as what comes in a horizon. ``seen_at`` is a
    timestamp column, by default the time of the micro-batch. Start it inside :func:`sinks.rocksdb`."""
    seen = F.current_timestamp() if seen_at is None else F.col(seen_at)
    timed = stream.withColumn("_seen", seen).withWatermark("_seen", horizon)
    return timed.dropDuplicatesWithinWatermark(["dataset_id", "relative_path"]).drop("_seen")


# Progress -------------------------------------------------------------------------------------------

_PROGRESS_SUMS = "done_files: bigint, done_bytes: bigint, last_ts: timestamp, first_ts: timestamp"
PROGRESS = (
    "window_start timestamp, run_id bigint, done_files bigint, done_bytes bigint, "
    "done_mib double, mib_per_sec double"
)


def _windows(events: DataFrame, interval: str) -> DataFrame:
    return events.groupBy(F.window("ts", interval), "run_id").agg(
        F.sum("file_count").alias("done_files"),
        F.sum("byte_count").alias("done_bytes"),
        F.max("ts").alias("last_ts"),
        F.min("ts").alias("first_ts"),
    )


def _progress(windows: DataFrame) -> DataFrame:
    seconds = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return windows.select(
        F.col("window.start").alias("window_start"),
        "run_id",
        "done_files",
        "done_bytes",
        F.round(mib(F.col("done_bytes")), 1).alias("done_mib"),
        mib_rate(F.col("done_bytes"), seconds).alias("mib_per_sec"),
    )


def stream_progress(stream: DataFrame, interval: str, lateness: str) -> DataFrame:
    """Files, bytes and rate per run and interval. Rows later than ``lateness`` are dropped."""
    return _progress(_windows(stream.withWatermark("ts", lateness), interval))


def start_progress(
    progress: DataFrame, folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write each interval of :func:`stream_progress` once, when no more rows can come for it; open
    intervals stay in the state."""
    return start(progress, folder, checkpoint, every)


def latest_progress(spark: SparkSession, folder: str, checkpoint: str) -> DataFrame:
    """Closed intervals as written, and open ones as they stand in the state."""
    closed = read_rows(spark, folder, PROGRESS)
    return closed.unionByName(_progress(state_rows(spark, checkpoint, _PROGRESS_SUMS)))


# Import status --------------------------------------------------------------------------------------

OUTCOMES = "project_id string, import_id string, status string, outcome string, waited_sec double"


def stream_import_status(
    stream: DataFrame, timeout_sec: float, lateness: str | None = None, keep_sec: float = WEEK_SEC
) -> DataFrame:
    """The end of each polled import (``project_id``, ``import_id``, ``status``, ``ts``), once: the first
    status that ends the wait, or ``timed_out`` without a status as soon as ``timeout_sec`` have passed
    since its first poll, whether or not it is polled again.

    The clock is that of the machine, so a silent import ends by itself while the stream runs. With
    ``lateness`` the clock is the stream's own: the largest ``ts`` less ``lateness``, which a replay
    repeats. An import that ended is forgotten ``keep_sec`` later.
    """
    polls = stream.select(
        "project_id",
        "import_id",
        "ts",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        "status",
        import_status_class(F.col("status")).alias("outcome"),
    )
    few = polls.where(F.col("ts").isNotNull()).mapInArrow(keyed.thin_polls, polls.schema)
    if lateness is not None:
        few = few.withWatermark("ts", lateness)
    watch = keyed.ImportWatch(int(timeout_sec * 1000), int(keep_sec * 1000), lateness is not None)
    clock = "ProcessingTime" if lateness is None else "EventTime"
    return few.groupBy("project_id", "import_id").transformWithState(watch, OUTCOMES, "Append", clock)


def open_imports(polls: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Imports without an end so far, with their last status, in the columns of ``outcomes``."""
    last = polls.groupBy("project_id", "import_id").agg(
        F.max_by("status", F.struct("ts", "status")).alias("status"),
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("waited_sec"),
    )
    left = last.join(outcomes, ["project_id", "import_id"], "left_anti")
    return left.withColumn("outcome", F.lit(keyed.PENDING)).select(*outcomes.columns)


# Milestones -----------------------------------------------------------------------------------------

MILESTONES = (
    "run_id bigint, target_files bigint, reached boolean, elapsed_sec double, accepted_files bigint"
)


def stream_first_n(
    stream: DataFrame, target: int = FIRST_TARGET, keep_sec: float = WEEK_SEC
) -> DataFrame:
    """One row per run, once, when it reaches ``target`` accepted files; elapsed from its first event.
    A micro-batch reads and writes the totals of the runs in it; a run without events for ``keep_sec`` is
    forgotten. Runs are dealt by hash into buckets, the keys of the state, where each has its own entry."""
    run = F.col("run_id").cast("bigint")
    files = stream.select(
        F.when(run.isNull(), keyed.NO_RUN).otherwise(F.pmod(F.hash(run), F.lit(BUCKETS))).alias("bucket"),
        run.alias("run_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        F.coalesce(F.col("event_id").cast("bigint"), F.lit(LAST)).alias("event_id"),
        F.greatest(F.lit(0), F.coalesce("file_count", F.lit(0))).cast("bigint").alias("files"),
    )
    few = files.where(F.col("us").isNotNull()).mapInArrow(keyed.buckets_of_files(target), keyed.FILES)
    runs = keyed.FirstN(target, int(keep_sec * 1000))
    return few.groupBy("bucket").transformWithStateInPandas(runs, MILESTONES, "Append", "ProcessingTime")


# File state -----------------------------------------------------------------------------------------

_STATE_KEYS = ["project_id", "import_id", "relative_path"]
_META = ["ts", "event_id", "object_key", "sha256", "size_bytes", "width", "height"]
_STATE = (
    "uploaded: boolean, streamed: boolean, meta: struct<ts: timestamp, event_id: bigint, "
    "object_key: string, sha256: string, size_bytes: bigint, width: int, height: int>"
)


def stream_file_state(stream: DataFrame) -> DataFrame:
    """Per-file updates folded by key: flags only turn on; metadata is that of the latest update. The
    fold is the state of an aggregation: a micro-batch touches the files that it names, and copies of
    an update or a replay change nothing."""
    return stream.groupBy(*_STATE_KEYS).agg(
        F.max(F.coalesce("uploaded", F.lit(False))).alias("uploaded"),
        F.max(F.coalesce("streamed", F.lit(False))).alias("streamed"),
        F.max(F.struct(*_META)).alias("meta"),
    )


def start_file_state(states: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return start_state(states, checkpoint, every)


def current_file_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """State after the last micro-batch."""
    found = state_rows(spark, checkpoint, _STATE)
    return found.select(*_STATE_KEYS, "uploaded", "streamed", "meta.*").drop("ts", "event_id")


# Flushes --------------------------------------------------------------------------------------------

FLUSHES = "dataset_id string, flush_id string, reason string, entries array<string>"


def micro_batches(
    stream: DataFrame,
    size: int = FLUSH_SIZE,
    wait_sec: float = 2.0,
    entry: Column | None = None,
    finished: Column | None = None,
) -> DataFrame:
    """Finished files of each dataset in flushes of exactly ``size``, over micro-batches: what is left
    over waits for more, ``wait_sec`` at most, or until a row for which ``finished`` holds says that its
    dataset is complete. ``entry`` is what is flushed of a file, its path by default; a row with a null
    entry is only a sign. A flush is named by the hash of its entries.

    Tasks make full flushes of the rows that they read; less than one for a dataset and task goes to the
    dataset's own state."""
    rows = stream.select(
        F.col("dataset_id").cast("string").alias("dataset_id"),
        (F.col("relative_path") if entry is None else entry).cast("string").alias("entry"),
        F.coalesce(F.lit(False) if finished is None else finished, F.lit(False)).alias("finished"),
    )
    blocks = rows.mapInArrow(keyed.blocks_of(size), keyed.BLOCK)
    flusher = keyed.Flusher(size, int(wait_sec * 1000))
    return blocks.groupBy("dataset_id", "lane").transformWithState(flusher, FLUSHES, "Append", "ProcessingTime")
