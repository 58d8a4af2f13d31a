"""File trees as tables: listing, content and metadata.

A tree lies on a folder that every executor mounts, or on a file system that pyarrow opens
(:class:`stores.Store`). Files are opened in the tasks, by ranges, and only those that a caller hands
over: a job reads what it needs of a tree, whatever else lies there. Nothing runs before an action.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import STATE_DIR, content_type, is_image
from tidemark.functions.text import decode_utf8
from tidemark.operators.planning import lacks_metadata
from tidemark.operators.verify import ERROR, finding
from tidemark.sources.image_headers import measure
from tidemark.sources.stores import Reader, Store
from tidemark.sources.tree_source import tree_files

_CHUNK = 1024 * 1024
#: Bytes that one Arrow batch of content holds, about, and that one row of a file in chunks holds.
BATCH_BYTES, CHUNK_BYTES = 16 << 20, 64 << 20
#: The largest value of a binary column.
LARGEST = 2**31 - 16
TOO_LARGE = "file is larger than a value can be: read it in chunks"
IMAGE_FAILED = "image_read_failed"


def as_store(root: str | Store) -> Store:
    return root if isinstance(root, Store) else Store(root)


def local_root(root: str) -> str:
    """Path for Python's file functions of a mounted folder."""
    store = Store(root)
    if not store.mounted:
        raise ValueError(f"only mounted folders have a local path, not {root}")
    return store.local()


def list_entries(spark: SparkSession, root: str | Store, state_dir: str = STATE_DIR) -> DataFrame:
    """(relative_path, size_bytes) of every regular file below ``root``, hidden and empty ones
    included. Lazy: the tree is listed by the tasks of each query, in as many as it has folders."""
    return tree_files(spark, as_store(root), state_dir).select("relative_path", "size_bytes")


def spread(files: DataFrame) -> DataFrame:
    """The same rows dealt over tasks, several for each core: a flat folder is split like any other."""
    spark = files.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(tasks, F.xxhash64("relative_path", F.lit(7)))


def list_files(
    spark: SparkSession,
    root: str | Store,
    dataset_id: str,
    state_dir: str = STATE_DIR,
    hash_files: bool = False,
) -> DataFrame:
    """Manifest of one file tree. Content is read only with ``hash_files``, in chunks, so files
    larger than a column value can hold are hashed too."""
    unknown = F.lit(None)
    listed = list_entries(spark, root, state_dir).select(
        F.lit(dataset_id).alias("dataset_id"),
        "relative_path",
        "size_bytes",
        content_type(F.col("relative_path")).alias("content_type"),
        unknown.cast("int").alias("width"),
        unknown.cast("int").alias("height"),
        unknown.cast("string").alias("sha256"),
    )
    if not hash_files:
        return listed
    every = spread(listed).withColumns({"_hash": F.lit(True), "_size": F.lit(False)})
    hashed = every.mapInArrow(_measure(as_store(root), every.columns), _with_found(every))
    return hashed.select(*[c for c in listed.columns if c != "sha256"], F.col("_sha256").alias("sha256"))


def _hash(files: Reader, name: str) -> str:
    digest = hashlib.sha256()
    with files.open(name) as handle:
        while chunk := handle.read(_CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _reason(exc: OSError) -> str:
    return f"file cannot be read: {exc.strerror or type(exc).__name__}"


_FOUND = "_sha256 string, _width int, _height int, _error string"


def _with_found(files: DataFrame) -> str:
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return f"{own}, {_FOUND}"


def _measure(
    store: Store, columns: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with what their files have: the hash where ``_hash`` asks for it, and width and height
    where ``_size`` does; of an image only the header is read for those."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = store.reader()
        for batch in batches:
            found: tuple[list, ...] = ([], [], [], [])
            for name, wants_hash, wants_size in zip(
                batch.column("relative_path").to_pylist(),
                batch.column("_hash").to_pylist(),
                batch.column("_size").to_pylist(),
                strict=True,
            ):
                digest, size = None, (None, None, None)
                try:
                    digest = _hash(files, name) if wants_hash else None
                    if wants_size:
                        with files.open(name) as handle:
                            size = measure(handle)
                except OSError as exc:
                    size = (None, None, _reason(exc))
                for column, value in zip(found, (digest, *size), strict=True):
                    column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, k) for v, k in zip(found, kinds, strict=True))],
                [*columns, "_sha256", "_width", "_height", "_error"],
            )

    return work


def read_content(files: DataFrame, root: str | Store) -> DataFrame:
    """The given files with their bytes as ``content``. Only they are opened. Where it is NULL,
    ``read_error`` says why: the file can't be read, or is larger than a column value can be, which
    :func:`read_chunks` reads."""
    store, columns = as_store(root), files.columns

    def content_of(reader: Reader, name: str) -> tuple[bytes | None, str | None]:
        try:
            if reader.size(name) > LARGEST:
                return None, TOO_LARGE
            with reader.open(name) as handle:
                return handle.read(), None
        except OSError as exc:
            return None, _reason(exc)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = store.reader()
        for batch in batches:
            first, held, size = 0, [], 0
            for at, name in enumerate(batch.column("relative_path").to_pylist()):
                held.append(content_of(reader, name))
                size += len(held[-1][0] or b"")
                if size >= BATCH_BYTES or at == batch.num_rows - 1:
                    part = batch.slice(first, len(held))
                    bodies, errors = zip(*held, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(bodies, pa.binary()), pa.array(errors, pa.string())],
                        [*columns, "content", "read_error"],
                    )
                    first, held, size = at + 1, [], 0

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return spread(files).mapInArrow(read, f"{own}, content binary, read_error string")


def read_chunks(files: DataFrame, root: str | Store, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(relative_path, offset, chunk, read_error): files of any size in pieces of ``chunk_bytes``, each
    read by itself, so one large file is read by many tasks. An empty file has one empty chunk."""
    store = as_store(root)
    last = F.greatest(F.lit(0), F.col("size_bytes") - 1)
    starts = F.sequence(F.lit(0).cast("bigint"), F.call_function("div", last, F.lit(chunk_bytes)))
    pieces = files.select("relative_path", F.explode(starts).alias("piece"))
    pieces = pieces.select("relative_path", (F.col("piece") * chunk_bytes).alias("offset"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = store.reader()
        for batch in batches:
            for row, (name, offset) in enumerate(
                zip(batch.column("relative_path").to_pylist(), batch.column("offset").to_pylist(), strict=True)
            ):
                chunk, error = None, None
                try:
                    with reader.open(name) as handle:
                        handle.seek(offset)
                        chunk = handle.read(chunk_bytes)
                except OSError as exc:
                    error = _reason(exc)
                own = batch.slice(row, 1)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array([chunk], pa.binary()), pa.array([error], pa.string())],
                    ["relative_path", "offset", "chunk", "read_error"],
                )

    dealt = pieces.repartition(
        max(4 * files.sparkSession.sparkContext.defaultParallelism, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))),
        F.xxhash64("relative_path", "offset"),
    )
    return dealt.mapInArrow(read, "relative_path string, offset bigint, chunk binary, read_error string")


def file_texts(files: DataFrame, root: str | Store) -> DataFrame:
    """Files as text; NULL where the bytes are not UTF-8 or could not be read."""
    return read_content(files.select("dataset_id", "relative_path", "size_bytes"), root).select(
        "dataset_id",
        F.col("relative_path").alias("path"),
        decode_utf8(F.col("content")).alias("text"),
    )


def add_missing_metadata(files: DataFrame, root: str | Store) -> DataFrame:
    """Fill hash and dimensions of only those files that lack them; known values are kept.

    Complete files are not opened, and of an image that only lacks dimensions nothing but its
    header is read. ``error`` tells why an image stays unmeasured.
    """
    both = (F.coalesce("width", F.lit(0)) > 0) & (F.coalesce("height", F.lit(0)) > 0)
    known_hash = F.when(F.coalesce("sha256", F.lit("")) != "", F.col("sha256"))
    lacking = spread(files.where(lacks_metadata())).withColumns(
        {"_hash": known_hash.isNull(), "_size": is_image(F.col("relative_path")) & ~both}
    )
    found = lacking.mapInArrow(_measure(as_store(root), lacking.columns), _with_found(lacking))
    filled = found.withColumns(
        {
            "width": F.when(both, F.col("width")).otherwise(F.col("_width")),
            "height": F.when(both, F.col("height")).otherwise(F.col("_height")),
            "sha256": F.coalesce(known_hash, F.col("_sha256")),
            "error": F.when(~both, F.col("_error")),
        }
    )
    complete = files.where(~lacks_metadata()).withColumn("error", F.lit(None).cast("string"))
    return complete.unionByName(filled.select(*files.columns, "error"))


def unreadable_images(described: DataFrame) -> DataFrame:
    """Findings for images whose dimensions could not be read."""
    bad = described.where(F.col("error").isNotNull())
    return finding(
        bad, ERROR, IMAGE_FAILED, path=F.col("relative_path"), message=F.col("error")
    )
