"""Queries that run a stream over a whole table to its end and read the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.plans.registry import query
from tidemark.plans.transfer_queries import FIRST_N_CHECK
from tidemark.plans.views import table, view
from tidemark.shared import new_path
from tidemark.streaming import feeds, sinks

#: A table arrives in so many parts, one after the other. Each is drained before the next one lands, so a
#: micro-batch is one part, however many files Spark makes of it.
ARRIVALS = 4


def _parts(rows: DataFrame, order: str) -> list[DataFrame]:
    """A table in parts, in the order of a column."""
    shares = F.array(*(F.lit(k / ARRIVALS) for k in range(1, ARRIVALS)))
    ends = rows.agg(F.percentile_approx(order, shares).alias("ends")).first()["ends"]
    made = []
    for k in range(ARRIVALS):
        part = rows if k == ARRIVALS - 1 else rows.where(F.col(order) <= F.lit(ends[k]))
        made.append(part.where(F.col(order) > F.lit(ends[k - 1])) if k else part)
    return made


def _drain(arrivals: list[list[tuple[DataFrame, str]]], start: Callable[[], StreamingQuery]) -> None:
    """Let parts land in their folders, arrival by arrival, and run the stream over each; it goes on from
    its checkpoint."""
    for landing in arrivals:
        for part, folder in landing:
            part.write.mode("append").parquet(folder)
        start().awaitTermination()


def _source(spark: SparkSession, sf_dir: str, source: str) -> tuple[str, StructType, list[tuple[DataFrame, str]]]:
    """Folder and schema of a table that arrives in the order of its key, and what lands there."""
    order = {"orders": "o_orderkey", "events": "ts"}[source]
    rows, folder = table(spark, sf_dir, source), new_path(spark, "arrivals")
    return folder, rows.schema, [(part, folder) for part in _parts(rows, order)]


def _stream(
    spark: SparkSession, sf_dir: str, view_name: str, source: str
) -> tuple[Callable[[], DataFrame], list[tuple[DataFrame, str]]]:
    """A view over a table that arrives as a stream of files, and the arrivals. The folder of the stream is
    there from the first arrival on."""
    folder, schema, arrivals = _source(spark, sf_dir, source)
    return lambda: view(spark, sf_dir, view_name, {source: feeds.file_stream(spark, folder, schema)}), arrivals


@query(
    "stream_new_files",
    "SELECT dataset_id, relative_path, CAST(max(size_bytes) AS BIGINT) AS size_bytes FROM v_files GROUP BY 1, 2",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing, once = _stream(spark, sf_dir, "v_files", "orders")
    listing_again, again = _stream(spark, sf_dir, "v_files", "orders")
    columns = ("dataset_id", "relative_path", "size_bytes")
    folder, checkpoint = new_path(spark, "feeds"), new_path(spark, "streams")

    def start() -> StreamingQuery:
        twice = listing().unionByName(listing_again())
        return sinks.start(feeds.stream_new_files(twice.select(*columns)), folder, checkpoint)

    _drain([list(pair) for pair in zip(once, again, strict=True)], start)
    return sinks.read_rows(spark, folder, view(spark, sf_dir, "v_files").select(*columns).schema)


@query(
    "stream_progress",
    """SELECT CAST(time_bucket(INTERVAL 6 HOURS, ts) AS TIMESTAMP) AS window_start, run_id,
        CAST(sum(file_count) AS BIGINT) AS done_files, CAST(sum(byte_count) AS BIGINT) AS done_bytes,
        round(sum(byte_count) / 1048576.0::DOUBLE, 1) AS done_mib,
        round(sum(byte_count) / 1048576.0::DOUBLE
          / greatest(0.001, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 2) AS mib_per_sec
      FROM v_transfer_events GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, arrivals = _stream(spark, sf_dir, "v_transfer_events", "events")
    folder, checkpoint = new_path(spark, "feeds"), new_path(spark, "streams")
    progress = lambda: feeds.stream_progress(events(), "6 hours", "1 day")
    _drain([[a] for a in arrivals], lambda: feeds.start_progress(progress(), folder, checkpoint))
    latest = feeds.latest_progress(spark, folder, checkpoint)
    return latest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_import_status",
    """WITH p AS (
        SELECT *, min(ts) OVER (PARTITION BY project_id, import_id) AS first_ts,
          trim(lower(status)) IN ('failed', 'succeeded') AS ended, max(ts) OVER () AS end_ts
        FROM v_polls),
      folded AS (
        SELECT project_id, import_id, min(first_ts) AS first_ts, max(ts) AS last_ts, min(end_ts) AS end_ts,
          arg_max(status, ts) AS last_status,
          min(ts) FILTER (ended AND epoch_ms(ts) < epoch_ms(first_ts) + 86400000) AS ended_ts,
          arg_min(status, ts) FILTER (ended AND epoch_ms(ts) < epoch_ms(first_ts) + 86400000) AS ended_status
        FROM p GROUP BY 1, 2),
      judged AS (
        SELECT *, ended_ts IS NULL AND epoch_ms(first_ts) + 86400000
          <= greatest(epoch_ms(last_ts), epoch_ms(end_ts) - 3600000) AS late FROM folded)
      SELECT project_id, import_id,
        CASE WHEN late THEN NULL ELSE coalesce(ended_status, last_status) END AS status,
        CASE WHEN late THEN 'timed_out' WHEN trim(lower(ended_status)) = 'failed' THEN 'failed'
          WHEN ended_status IS NOT NULL THEN 'success' ELSE 'pending' END AS outcome,
        CASE WHEN late THEN 86400.0::DOUBLE
          ELSE (epoch_us(coalesce(ended_ts, last_ts)) - epoch_us(first_ts)) / 1e6 END AS waited_sec
      FROM judged""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    polls, arrivals = _stream(spark, sf_dir, "v_polls", "events")
    folder, checkpoint = new_path(spark, "feeds"), new_path(spark, "streams")
    ends = lambda: feeds.stream_import_status(polls(), 86400.0, "1 hour", 1e9)
    _drain([[a] for a in arrivals], lambda: sinks.start(ends(), folder, checkpoint))
    outcomes = sinks.read_rows(spark, folder, feeds.OUTCOMES)
    return outcomes.unionByName(feeds.open_imports(view(spark, sf_dir, "v_polls"), outcomes))


@query("stream_first_n", f"SELECT * FROM ({FIRST_N_CHECK}) WHERE reached")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, arrivals = _stream(spark, sf_dir, "v_transfer_events", "events")
    folder, checkpoint = new_path(spark, "feeds"), new_path(spark, "streams")
    runs = lambda: feeds.stream_first_n(events())
    _drain([[a] for a in arrivals], lambda: sinks.start(runs(), folder, checkpoint, timers=True))
    return sinks.read_rows(spark, folder, feeds.MILESTONES)


@query(
    "stream_file_state",
    """SELECT project_id, import_id, relative_path, bool_or(uploaded) AS uploaded,
        bool_or(streamed) AS streamed, arg_max(object_key, ts) AS object_key,
        arg_max(size_bytes, ts) AS size_bytes FROM v_updates GROUP BY 1, 2, 3""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates, arrivals = _stream(spark, sf_dir, "v_updates", "events")
    checkpoint = new_path(spark, "streams")
    states = lambda: feeds.stream_file_state(updates())
    _drain([[a] for a in arrivals], lambda: feeds.start_file_state(states(), checkpoint))
    state = feeds.current_file_state(spark, checkpoint)
    return state.drop("sha256", "width", "height")


@query(
    "micro_batches",
    """SELECT dataset_id, relative_path, 1::BIGINT AS in_flushes, true AS full_or_last FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path", "file_no")
    arrivals, folder, checkpoint = (new_path(spark, kind) for kind in ("arrivals", "feeds", "streams"))
    ends = rows.select("dataset_id").distinct().withColumns(
        {"relative_path": F.lit(None).cast("string"), "file_no": F.lit(None).cast(rows.schema["file_no"].dataType)}
    )

    def flushes() -> DataFrame:
        files = feeds.file_stream(spark, arrivals, rows.schema)
        return feeds.micro_batches(files, wait_sec=3600.0, finished=F.col("relative_path").isNull())

    landing = [[(part, arrivals)] for part in [*_parts(rows, "file_no"), ends]]
    _drain(landing, lambda: sinks.start(flushes(), folder, checkpoint, timers=True))
    cut = sinks.read_rows(spark, folder, feeds.FLUSHES).withColumn("short", F.size("entries") < feeds.FLUSH_SIZE)
    shorts = cut.where("short").groupBy("dataset_id").agg(F.count("*").alias("shorts"))
    good = (F.size("entries") == feeds.FLUSH_SIZE) | (
        F.col("short") & (F.col("reason") == "finished") & (F.col("shorts") == 1)
    )
    whole = cut.join(shorts, "dataset_id", "left")
    each = whole.select("dataset_id", F.explode("entries").alias("relative_path"), good.alias("good"))
    return each.groupBy("dataset_id", "relative_path").agg(
        F.count("*").alias("in_flushes"), F.bool_and("good").alias("full_or_last")
    )
