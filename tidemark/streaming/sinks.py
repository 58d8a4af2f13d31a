"""Where streams write and how they keep state.

Rows of a feed go to a Parquet folder with Spark's own file sink: each micro-batch is committed once, a
restart from the checkpoint repeats nothing, and a reader sees whole micro-batches only. State lives in
RocksDB state stores below the checkpoint, so a micro-batch reads and writes the keys it meets, and what
Spark keeps of old micro-batches is bounded by ``spark.sql.streaming.minBatchesToRetain``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemark.shared import new_path

_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_EMPTY_BATCHES_KEY = "spark.sql.streaming.noDataMicroBatches.enabled"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what starts inside; the session's own come back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rocksdb(spark: SparkSession, others: dict[str, str] | None = None) -> AbstractContextManager:
    """Streams started inside keep their state in RocksDB."""
    return settings(spark, {_PROVIDER_KEY: _ROCKSDB} | (others or {}))


def _start(
    writer: DataStreamWriter, stream: DataFrame, checkpoint: str | None, every: str | None, timers: bool = False
) -> StreamingQuery:
    location = checkpoint or new_path(stream.sparkSession, "streams")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    empty_batches = str(bool(every) or not timers).lower()
    with rocksdb(stream.sparkSession, {_EMPTY_BATCHES_KEY: empty_batches}):
        return writer.option("checkpointLocation", location).trigger(**trigger).start()


def start(
    stream: DataFrame,
    folder: str,
    checkpoint: str | None = None,
    every: str | None = None,
    timers: bool = False,
) -> StreamingQuery:
    """Append a stream's rows to ``folder``: what is there now, or, with an interval such as
    ``"10 seconds"``, until it is stopped. ``timers`` says that the stream waits by the machine's clock:
    such a stream would go on for ever with empty micro-batches, so without an interval it ends after
    its last row and leaves what waits in its state, for the next start."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", folder)
    return _start(writer, stream, checkpoint, every, timers)


def start_state(stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run an aggregation for its state alone, which :func:`state_rows` reads."""
    return _start(stream.writeStream.outputMode("update").format("noop"), stream, checkpoint, every)


def read_rows(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """What a stream wrote so far, empty before its first micro-batch."""
    empty = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(folder).select(*empty.columns)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty


def state_rows(spark: SparkSession, checkpoint: str, aggregates: str) -> DataFrame:
    """Grouping columns and aggregates of a stream's only aggregation after its last micro-batch.
    ``aggregates`` names and types the aggregates in their order: the state calls two sums alike."""
    with rocksdb(spark):
        state = spark.read.format("statestore").load(checkpoint)
        return state.select("key", F.col("value").cast(f"struct<{aggregates}>")).select("key.*", "value.*")
