"""File trees as a Spark data source, ``tidemark_tree``: rows (relative_path, size_bytes, modified).

Reading is lazy. When a query runs, the planner walks down from the root only until it has enough
folders for the tasks; those list what is in them and below. Filters on the path reach the reader: a
prefix leaves out folders, a suffix leaves out files. As a stream it gives the files of a tree as they
appear, by their times of modification.
"""

from __future__ import annotations

import base64
import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    InputPartition,
    IsNotNull,
    StringEndsWith,
    StringStartsWith,
)

from tidemark.sources.stores import Entry, Store

NAME = "tidemark_tree"
SCHEMA = "relative_path string, size_bytes bigint, modified timestamp"
_ARROW = pa.schema(
    [("relative_path", pa.string()), ("size_bytes", pa.int64()), ("modified", pa.timestamp("us", tz="UTC"))]
)
#: The planner stops at so many folders, or when it has seen so many entries.
FOLDERS, ENTRIES = 256, 100_000
BATCH = 10_000


class Folder(InputPartition):
    """A folder that one task lists: with all below it, or only its own files."""

    def __init__(self, path: str, deep: bool, since_us: int | None = None, until_us: int | None = None) -> None:
        super().__init__(path)
        self.path, self.deep, self.since_us, self.until_us = path, deep, since_us, until_us


class Listing:
    """What both readers share."""

    def __init__(self, options: dict[str, str]) -> None:
        self.store: Store = cloudpickle.loads(base64.b64decode(options["store"]))
        self.state_dir = options.get("state_dir")
        self.prefixes: list[str] = []
        self.suffixes: list[str] = []

    def _wanted_folder(self, path: str) -> bool:
        below = f"{path}/"
        return all(below.startswith(p) or p.startswith(below) for p in self.prefixes)

    def _wanted_file(self, path: str) -> bool:
        return all(map(path.startswith, self.prefixes)) and all(map(path.endswith, self.suffixes))

    def _entries(self, folder: str) -> Iterator[Entry]:
        for entry in self.store.entries(folder):
            name = entry.path.rsplit("/", 1)[-1]
            if name != self.state_dir and (not entry.is_dir or self._wanted_folder(entry.path)):
                yield entry

    def folders(self) -> list[tuple[str, bool]]:
        """Folders for tasks, level by level: those that were looked into are listed for their own files
        only, the last level with all below it. The files met on the way are not kept."""
        looked, level, seen = [], [""], 0
        while level and len(level) < FOLDERS and seen < ENTRIES:
            below = []
            for folder in level:
                for entry in self._entries(folder):
                    seen += 1
                    if entry.is_dir:
                        below.append(entry.path)
            looked += level
            level = below
        return [(f, False) for f in looked] + [(f, True) for f in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        rows: list[Entry] = []
        waiting = [partition.path]
        while waiting:
            for entry in self._entries(waiting.pop()):
                if entry.is_dir:
                    if partition.deep:
                        waiting.append(entry.path)
                    continue
                late = partition.until_us is not None and not (
                    partition.since_us < entry.modified_us <= partition.until_us
                )
                if late or not self._wanted_file(entry.path):
                    continue
                rows.append(entry)
                if len(rows) == BATCH:
                    yield self._batch(rows)
                    rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[Entry]) -> pa.RecordBatch:
        columns = ([r.path for r in rows], [r.size for r in rows], [r.modified_us for r in rows])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


class TreeReader(Listing, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            if getattr(one, "attribute", None) != ("relative_path",):
                yield one
            elif isinstance(one, StringStartsWith):
                self.prefixes.append(one.value)
            elif isinstance(one, StringEndsWith):
                self.suffixes.append(one.value)
            elif isinstance(one, EqualTo):
                self.prefixes.append(one.value)
                yield one
            elif not isinstance(one, IsNotNull):  # a path is never null
                yield one

    def partitions(self) -> Sequence[InputPartition]:
        return [Folder(path, deep) for path, deep in self.folders()]


class TreeStreamReader(Listing, DataSourceStreamReader):
    """Files by modification time: a micro-batch has those modified since the one before."""

    def initialOffset(self) -> dict:
        return {"until_us": -1}

    def latestOffset(self) -> dict:
        # Files of this moment may still be followed by others with the same time.
        return {"until_us": (time.time_ns() // 1_000_000 - 100) * 1000}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Folder(path, deep, start["until_us"], end["until_us"]) for path, deep in self.folders()]


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)

    def streamReader(self, schema) -> TreeStreamReader:
        return TreeStreamReader(self.options)


def _options(store: Store, state_dir: str | None) -> dict[str, str]:
    packed = base64.b64encode(cloudpickle.dumps(store)).decode()
    return {"store": packed} | ({"state_dir": state_dir} if state_dir else {})


def _register(spark: SparkSession, store: Store) -> None:
    if not store.is_folder():
        raise ValueError(f"no such folder: {store.root}")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TreeSource)


def tree_files(spark: SparkSession, store: Store, state_dir: str | None = None) -> DataFrame:
    """Every regular file below the root; what is called ``state_dir`` is left out."""
    _register(spark, store)
    return spark.read.format(NAME).options(**_options(store, state_dir)).load()


def tree_file_stream(spark: SparkSession, store: Store, state_dir: str | None = None) -> DataFrame:
    """The files of a tree as they appear or change."""
    _register(spark, store)
    return spark.readStream.format(NAME).options(**_options(store, state_dir)).load()
