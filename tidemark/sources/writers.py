"""Sinks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.imports import IMPORT_KEYS
from tidemark.shared import finished_writes, remove, write_and_read

_VERSION = "version"


def write_manifest(files: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Manifest rows, each with its dataset, in files as large as tasks make them: their number grows with
    the rows, not with the datasets. Rebalancing brings a dataset into few files and splits one too large
    for a task; its rows stand together there, so a reader of one dataset skips the rest by statistics
    where the format has them."""
    balanced = files.hint("rebalance", "dataset_id").sortWithinPartitions("dataset_id")
    balanced.write.mode("overwrite").format(fmt).save(path)


def write_import_state(import_files: DataFrame, path: str) -> str:
    """Replace the stored rows of exactly the imports present in ``import_files``; returns the version.

    A write is a folder of its own and touches no other. Readers see it once Spark has finished it, so
    never in part, and take each import from the last version that has it: writers at the same time lose
    nothing of each other's imports, and of one import the write that began later stands. A write that
    fails leaves a folder that is never read. Versions are named by the clock of the driver.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    import_files.write.parquet(f"{path}/{_VERSION}={version}")
    return version


def _versions(spark: SparkSession, path: str, names: list[str], schema: StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(schema).option("basePath", path)
    return read.parquet(*(f"{path}/{name}" for name in names))


def read_import_state(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of each import from its last finished write, as of this call."""
    return _current(spark, path, finished_writes(spark, path), schema).drop(_VERSION)


def _current(spark: SparkSession, path: str, names: list[str], schema: StructType | str) -> DataFrame:
    own = spark.createDataFrame([], schema).schema
    rows = _versions(spark, path, names, StructType([*own.fields]).add(_VERSION, "string"))
    # The largest of strings is found by sorting all of them. Distinct pairs come by hash, and are written
    # before the rest is planned: Spark would drop the distinct, and few imports spare the rows a shuffle.
    held = rows.select(*(F.col(k).alias(f"_{k}") for k in IMPORT_KEYS), _VERSION).distinct()
    held = write_and_read(held, "versions")
    last = held.groupBy(*(f"_{k}" for k in IMPORT_KEYS)).agg(F.max(_VERSION).alias("_last"))
    same = [rows[k].eqNullSafe(last[f"_{k}"]) for k in IMPORT_KEYS]
    kept = rows.join(last, [*same, rows[_VERSION] == last["_last"]], "left_semi")
    return kept.select(*own.names, _VERSION)


def fold_import_state(spark: SparkSession, path: str, schema: StructType | str) -> None:
    """Make one version of all that are finished now, and remove those. Writers may go on meanwhile: what
    they finish counts as later. Readers that began before must be done."""
    names = finished_writes(spark, path)
    if len(names) > 1:
        rows = _current(spark, path, names, schema).drop(_VERSION)
        # Sorts behind the newest of the versions in it and before any that begins later.
        rows.write.parquet(f"{path}/{names[-1]}~{uuid.uuid4().hex}")
        for name in names:
            remove(spark, f"{path}/{name}")
