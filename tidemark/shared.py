"""The folder every executor can reach, and tables written there to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIRS: dict[str, str] = {}
_NOTED: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Root for written tables and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is used only for a
    local master, where there is one machine.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_KEY
    )
    if named:
        return named.rstrip("/")
    named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, kind: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{kind}/{uuid.uuid4().hex}"


@contextmanager
def written_tables() -> Iterator[list[str]]:
    """Paths of the tables that :func:`write_and_read` writes inside: for a caller who knows when nothing
    reads them any more, and then has :func:`remove` take them away."""
    made: list[str] = []
    _NOTED.append(made)
    try:
        yield made
    finally:
        _NOTED.pop()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files when it ends, not when the driver's garbage is collected."""
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP_KEY) if before is None else spark.conf.set(_CLEANUP_KEY, before)


def write_and_read(df: DataFrame, kind: str = "tables") -> DataFrame:
    """Write ``df`` once and read it back: later stages see one fixed copy whatever executor is
    lost, and read only the columns they use."""
    path = new_path(df.sparkSession, kind)
    df.write.parquet(path)
    for made in _NOTED:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, where it isn't installed on them: tasks import it."""
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/tidemark", "zip", root.parent, root.name
    )
    spark.sparkContext.addPyFile(archive)


def _file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of ``path``, and the path as it knows it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more, on whatever file system it lies."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def finished_writes(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` that a Spark job has written to its end, in order. Spark leaves
    ``_SUCCESS`` as a job's last act, so a folder is here whole or not at all."""
    files, hadoop = _file_system(spark, f"{path}/*/_SUCCESS")
    return sorted(status.getPath().getParent().getName() for status in files.globStatus(hadoop) or ())
