"""Manifest roll-ups, ordered truncation and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import (
    STATE_DIR,
    component_order,
    expected_label_path,
    is_dataset_image,
    is_image,
    is_label,
    is_sample_metadata,
    not_state_dir,
)
from tidemark.functions.text import strip
from tidemark.operators.ordering import top_k



def limit_files(files: DataFrame, n: int) -> DataFrame:
    """First ``n`` files of each dataset in component order."""
    return top_k(files, ["dataset_id"], [component_order(F.col("relative_path"))], n).drop("rank")


def collect_first(
    df: DataFrame, keys: Sequence[str], value: str, order: Column, k: int, name: str
) -> DataFrame:
    """Array of the first ``k`` values per key, in order."""
    few = top_k(df.select(*keys, value), keys, [order], k)
    listed = F.array_sort(F.collect_list(F.struct("rank", value)))
    return few.groupBy(*keys).agg(F.transform(listed, lambda x: x[value]).alias(name))


def sample_files(files: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` manifest paths of each dataset."""
    order = component_order(F.col("relative_path"))
    return collect_first(files, ["dataset_id"], "relative_path", order, k, "sample_files")


def sample_missing(missing: DataFrame, k: int = 5, name: str = "sample_missing") -> DataFrame:
    """First ``k`` offending paths of each dataset in manifest order."""
    order = component_order(F.col("relative_path"))
    return collect_first(missing, ["dataset_id"], "relative_path", order, k, name)


def class_counts(classes: DataFrame) -> DataFrame:
    return classes.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("class_count"))


def class_lists(classes: DataFrame) -> DataFrame:
    """Class names in id order. A catalog comes from one metadata document, so the list is no
    longer than a value that was already held in one row."""
    listed = F.array_sort(F.collect_list(F.struct("class_id", "class_name")))
    return classes.groupBy("dataset_id").agg(
        F.transform(listed, lambda x: x["class_name"]).alias("classes")
    )


def file_counts(files: DataFrame) -> DataFrame:
    path = F.col("relative_path")
    return files.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size_bytes").alias("total_bytes"),
        F.count_if(is_image(path)).alias("image_count"),
        F.count_if(is_label(path)).alias("label_count"),
    )


def dataset_summary(datasets: DataFrame, files: DataFrame, classes: DataFrame) -> DataFrame:
    """One row per dataset, empty ones included. Images count anywhere in the tree."""
    zero = F.lit(0)
    joined = (
        datasets.join(file_counts(files), "dataset_id", "left")
        .join(sample_files(files), "dataset_id", "left")
        .join(class_lists(classes), "dataset_id", "left")
    )
    empty = F.expr("CAST(array() AS array<string>)")
    return joined.select(
        "dataset_id",
        "source",
        F.lower("format").alias("format"),
        *[
            F.coalesce(F.col(c), zero).alias(c)
            for c in ("file_count", "total_bytes", "image_count", "label_count")
        ],
        F.coalesce("classes", empty).alias("classes"),
        F.coalesce("sample_files", empty).alias("sample_files"),
    )


def session_record(summary: DataFrame, overrides: DataFrame) -> DataFrame:
    """Row that opens an upload session. ``overrides`` holds, per dataset, a task key, a flag and
    an optional explicit class list, which wins over the catalog. Blank catalog names are dropped
    and the others stripped; an explicit list is kept as given."""
    catalog = F.filter(F.transform("classes", strip), lambda c: c != "")
    explicit = F.col("explicit_classes")
    return summary.join(overrides, "dataset_id", "left").select(
        "dataset_id",
        "format",
        F.substring_index("source", "/", -1).alias("root_name"),
        "task_key",
        F.when(F.size(explicit) > 0, explicit).otherwise(catalog).alias("classes"),
        "file_count",
        "total_bytes",
        F.coalesce("auto_crop_embedding", F.lit(True)).alias("auto_crop_embedding"),
    )


def archive_summary(files: DataFrame, state_dir: str = STATE_DIR) -> DataFrame:
    """What one archive per dataset would hold: every file outside the state directory."""
    kept = files.where(not_state_dir(F.col("relative_path"), state_dir))
    return kept.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("size_bytes").alias("payload_bytes")
    )


def sample_labels(files: DataFrame, images: DataFrame) -> DataFrame:
    """Label files of the given images, where present."""
    wanted = images.select(
        "dataset_id", expected_label_path(F.col("relative_path")).alias("relative_path")
    )
    labels = files.where(is_label(F.col("relative_path")))
    return labels.join(wanted, ["dataset_id", "relative_path"], "left_semi")


def sample_selection(files: DataFrame, n: int) -> DataFrame:
    """Rows a sample of ``n`` images keeps, with the ``part`` each belongs to.

    The three parts cannot overlap (below images/, below labels/, at the root), so their union is
    already a set and needs no further shuffle.
    """
    path = F.col("relative_path")
    images = top_k(files.where(is_dataset_image(path)), ["dataset_id"], [path], n).drop("rank")
    labels = sample_labels(files, images)
    metadata = files.where(is_sample_metadata(path))
    return (
        images.withColumn("part", F.lit("image"))
        .unionByName(labels.withColumn("part", F.lit("label")))
        .unionByName(metadata.withColumn("part", F.lit("metadata")))
    )


def limit_samples(files: DataFrame, n: int) -> DataFrame:
    """Manifest of the first ``n`` images in string order, their labels and root metadata."""
    return sample_selection(files, n).drop("part")
