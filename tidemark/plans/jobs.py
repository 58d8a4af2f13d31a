"""Whole jobs over one file tree: what a caller runs when the data is still files.

Every job is a few operators put together; over many datasets use the operators themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import STATE_DIR, is_label, safe_segment
from tidemark.operators import imports as import_operators
from tidemark.operators import parts, planning, summary, verify
from tidemark.schemas import CLASSES, FORMATS
from tidemark.shared import write_and_read
from tidemark.sources import documents, filetree, imports


@dataclass
class Tree:
    """One dataset as tables."""

    datasets: DataFrame
    files: DataFrame
    classes: DataFrame
    root: str
    class_problems: DataFrame


def _limited(
    files: DataFrame, fmt: str, max_files: int | None, max_samples: int | None
) -> DataFrame:
    if max_samples is not None:
        if fmt != "yolo":
            raise ValueError("max_samples is for YOLO datasets")
        return summary.limit_samples(files, max_samples)
    if max_files is not None:
        if fmt == "yolo":
            raise ValueError("YOLO datasets are limited by max_samples, not max_files")
        return summary.limit_files(files, max_files)
    return files


def open_tree(
    spark: SparkSession,
    root: str,
    fmt: str = "yolo",
    dataset_id: str = "dataset",
    state_dir: str = STATE_DIR,
    max_files: int | None = None,
    max_samples: int | None = None,
) -> Tree:
    """Tables of one file tree. Class names come from the whole tree, whatever the limits are.

    The tree is listed once, when called, and that listing is what every later step sees. Of the
    files themselves only the class document is opened.
    """
    fmt = fmt.strip().lower()
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}")
    for name, value in (("max_files", max_files), ("max_samples", max_samples)):
        if value is not None and value <= 0:
            raise ValueError(f"{name} must be greater than 0")
    every = write_and_read(filetree.list_files(spark, root, dataset_id, state_dir))
    datasets = every.sparkSession.range(1).select(
        F.lit(dataset_id).alias("dataset_id"), F.lit(root).alias("source"), F.lit(fmt).alias("format")
    )
    if fmt == "yolo":
        chosen = every.join(
            documents.select_class_metadata(every), ["dataset_id", "relative_path"], "left_semi"
        )
        texts = write_and_read(filetree.file_texts(chosen, root))
        classes, problems = documents.class_catalog(texts)
    else:
        classes = spark.createDataFrame([], CLASSES)
        problems = verify.findings(verify.finding(datasets.where(F.lit(False)), "error", "none"))
    files = _limited(every, fmt, max_files, max_samples)
    return Tree(datasets, files, classes, root, problems.select(*verify.FINDING_COLUMNS))


def inspect_tree(spark: SparkSession, root: str, fmt: str = "yolo", **options: object) -> DataFrame:
    """Summary of one tree."""
    tree = open_tree(spark, root, fmt, **options)
    return summary.dataset_summary(tree.datasets, tree.files, tree.classes)


def verify_tree(
    spark: SparkSession, root: str, fmt: str = "yolo", **options: object
) -> tuple[DataFrame, DataFrame]:
    """Verdict and findings of one tree, the findings in no particular order; sort them by
    ``operators.verify.REPORT_ORDER``."""
    tree = open_tree(spark, root, fmt, **options)
    labels = tree.files.where(is_label(F.col("relative_path")))
    texts = filetree.file_texts(labels, tree.root)
    lines = documents.read_label_lines(texts)
    found = verify.dataset_findings(tree.datasets, tree.files, tree.classes, lines)
    if fmt.strip().lower() == "yolo":
        found = verify.findings(
            found.drop("rule_order", "line_order"),
            documents.unreadable_labels(texts),
            tree.class_problems,
        )
    rolled = summary.dataset_summary(tree.datasets, tree.files, tree.classes)
    return verify.verify_dataset(rolled, found), found


def upload_plan(
    spark: SparkSession,
    root: str,
    state: DataFrame,
    fmt: str = "yolo",
    batch_size: int = planning.MAX_BATCH,
    **options: object,
) -> DataFrame:
    """Files of one tree with batch and what each still needs; ``state`` holds the resume state's
    files under the same dataset id."""
    tree = open_tree(spark, root, fmt, **options)
    split = planning.resume_split(tree.files, state)
    return planning.assign_batches(split, planning.check_batch_size(batch_size))


def archive_plan(
    spark: SparkSession, archives: DataFrame, sign_batch: int = parts.SIGN_BATCH
) -> DataFrame:
    """Parts of archives with the batch each is signed in."""
    return parts.sign_batches(parts.part_ranges(archives), sign_batch)


def cleanup_plan(
    spark: SparkSession, state_dir: str, listing_dir: str, project_id: str
) -> tuple[DataFrame, DataFrame]:
    """Local states of one project that can go, given its landed import listing; and all its local
    states with the files they count."""
    segment = spark.range(1).select(safe_segment(F.lit(project_id))).first()[0]
    states, files = imports.read_import_states(spark, state_dir, segment)
    listed = imports.read_server_imports(spark, listing_dir, segment)
    # Projects are told apart by folder name, on both sides.
    owned = states.withColumn("project_id", F.lit(segment))
    actions = import_operators.cleanup_actions(owned, listed).withColumn(
        "project_id", F.lit(project_id)
    )
    return actions, states.join(
        import_operators.import_state_counts(files, states), list(import_operators.IMPORT_KEYS)
    )
