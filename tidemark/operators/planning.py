"""Batches, resume deltas and completeness of an upload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import component_order, content_type, is_image
from tidemark.functions.sizes import fill_missing_number, fill_missing_text
from tidemark.functions.text import strip
from tidemark.operators.ordering import last_wins, number_rows
from tidemark.operators.summary import collect_first, sample_missing

KEYS = ("dataset_id", "relative_path")
MAX_BATCH = 1000
# What a file still needs.
PENDING_UPLOAD = "pending_upload"
PENDING_STREAM = "pending_stream"
DONE = "done"


def assign_batches(
    rows: DataFrame,
    size: int,
    group: Sequence[str] = ("dataset_id",),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Number rows in manifest order and cut them into batches of ``size``."""
    size = max(1, int(size))
    order = list(order) if order else [component_order(F.col("relative_path"))]
    numbered = number_rows(rows, list(group), order)
    return numbered.withColumn("batch_id", F.call_function("div", F.col("row_index"), F.lit(size)))


def check_batch_size(size: int) -> int:
    if not 1 <= int(size) <= MAX_BATCH:
        raise ValueError(f"batch size must be between 1 and {MAX_BATCH}")
    return int(size)


def batch_totals(batched: DataFrame) -> DataFrame:
    return batched.groupBy("dataset_id", "batch_id").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("byte_count")
    )


def batch_manifests(files: DataFrame, batch_size: int) -> DataFrame:
    """One JSON request body per batch; a batch holds at most a thousand files."""
    batched = assign_batches(files, check_batch_size(batch_size))
    fields = [c for c in files.columns if c != "dataset_id"]
    rows = F.array_sort(F.collect_list(F.struct("row_index", F.struct(*fields).alias("file"))))
    return batched.groupBy("dataset_id", "batch_id").agg(
        F.to_json(F.struct(F.transform(rows, lambda r: r["file"]).alias("files"))).alias("body")
    )


def resume_split(files: DataFrame, state: DataFrame, detect_changes: bool = False) -> DataFrame:
    """What each manifest file still needs. Only the path is compared, as a resume does: files
    the state does not know are pending, paths only the state knows are ignored.

    ``detect_changes`` is an addition: a file whose size or hash is known on both sides and differs is
    uploaded anew. Both ride along on the join that the flags need."""
    compared = [c for c in ("size_bytes", "sha256") if detect_changes and {c} <= {*files.columns} & {*state.columns}]
    flags = state.select(*KEYS, "uploaded", "streamed", *[F.col(c).alias(f"_{c}") for c in compared])
    changed = F.lit(False)
    for name, missing in (("size_bytes", 0), ("sha256", "")):
        if name in compared:
            mine, stored = (F.nullif(F.col(c), F.lit(missing)) for c in (name, f"_{name}"))
            changed = changed | F.coalesce(mine != stored, F.lit(False))
    uploaded = F.coalesce("uploaded", F.lit(False)) & ~changed
    streamed = F.coalesce("streamed", F.lit(False))
    status = F.when(~uploaded, PENDING_UPLOAD).when(~streamed, PENDING_STREAM).otherwise(DONE)
    return files.join(flags, list(KEYS), "left").select(*files.columns, status.alias("status"))


def enrich_from_state(files: DataFrame, state: DataFrame) -> DataFrame:
    """Fill missing metadata from the state; the content type is derived last."""
    texts = {"sha256"}
    fields = [c for c in ("sha256", "size_bytes", "width", "height") if c in state.columns]
    known = state.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in fields])
    joined = files.join(known, list(KEYS), "left")

    def value(name: str) -> Column:
        if name in fields:
            fill = fill_missing_text if name in texts else fill_missing_number
            return fill(F.col(name), F.col(f"_{name}")).alias(name)
        if name == "content_type":
            guessed = content_type(F.col("relative_path"))
            return F.coalesce(F.nullif(F.col(name), F.lit("")), guessed).alias(name)
        return F.col(name)

    return joined.select(*[value(c) for c in files.columns])


def match_signed_urls(pending: DataFrame, responses: DataFrame) -> DataFrame:
    """Pending files with their signed URL, NULL where the response has none or a blank one.

    ``responses`` holds ``upload_url``, ``url`` and an ``ordinal``; the last one per path wins.
    """
    latest = last_wins(responses, KEYS, "ordinal")
    signed = strip(
        F.coalesce(F.nullif(F.col("upload_url"), F.lit("")), F.col("url"), F.lit(""))
    )
    urls = latest.select(*KEYS, F.nullif(signed, F.lit("")).alias("signed_url"))
    return pending.join(urls, list(KEYS), "left")


def unsigned_files(matched: DataFrame, k: int = 5) -> DataFrame:
    """Datasets with files that got no URL: how many, and the first few."""
    lacking = matched.where(F.col("signed_url").isNull()).select(*KEYS)
    counts = lacking.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("missing_count"))
    return counts.join(sample_missing(lacking, k), "dataset_id")


def upload_completeness(files: DataFrame, state: DataFrame, k: int = 5) -> DataFrame:
    """Per dataset: files expected, not uploaded, uploaded but not streamed, with samples.

    The total needs no join; of the joined rows only unfinished ones go on.
    """
    expected = files.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("expected"))
    split = resume_split(files.select(*KEYS), state).where(F.col("status") != DONE)
    keys = ["dataset_id", "status"]
    order = component_order(F.col("relative_path"))
    counts = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    unfinished = counts.join(
        collect_first(split, keys, "relative_path", order, k, "sample"), keys
    ).groupBy("dataset_id")

    def of(status: str, value: str) -> Column:
        return F.max(F.when(F.col("status") == status, F.col(value)))

    found = unfinished.agg(
        of(PENDING_UPLOAD, "n").alias("uploaded_missing"),
        of(PENDING_STREAM, "n").alias("streamed_missing"),
        of(PENDING_UPLOAD, "sample").alias("sample_uploaded_missing"),
        of(PENDING_STREAM, "sample").alias("sample_streamed_missing"),
    )
    zero = F.lit(0)
    return expected.join(found, "dataset_id", "left").select(
        "dataset_id",
        "expected",
        F.coalesce("uploaded_missing", zero).alias("uploaded_missing"),
        F.coalesce("streamed_missing", zero).alias("streamed_missing"),
        "sample_uploaded_missing",
        "sample_streamed_missing",
    )


def lacks_metadata() -> Column:
    """Files without a hash, and images without both dimensions."""
    no_hash = strip(F.coalesce("sha256", F.lit(""))) == ""
    no_size = (F.coalesce("width", F.lit(0)) == 0) | (F.coalesce("height", F.lit(0)) == 0)
    return no_hash | (is_image(F.col("relative_path")) & no_size)
