"""Integrity findings over images, labels and class names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import (
    UNKNOWN_CLASS,
    UNKNOWN_MESSAGE,
    class_value,
    is_blank,
    is_odd,
    is_short,
    label_code,
    label_coords,
    label_message,
    line_facts,
)
from tidemark.functions.paths import (
    expected_label_path,
    is_class_file,
    is_dataset_image,
    is_image,
    is_label,
)
from tidemark.functions.text import strip
from tidemark.operators.ordering import lookup
from tidemark.schemas import FINDINGS

ERROR = "error"
WARNING = "warning"
FINDING_COLUMNS = [part.split()[0] for part in FINDINGS.split(", ")]

# Finding codes and messages of the manifest rules.
NO_IMAGES = "no_images"
NO_IMAGES_YOLO_MESSAGE = "YOLO dataset has no images/"
NO_IMAGES_MESSAGE = "dataset has no image files"
MISSING_NAMES = "missing_class_names"
MISSING_NAMES_MESSAGE = "YOLO dataset has no classes.txt or data.yaml class names"
MISSING_LABEL = "missing_yolo_label"
MISSING_LABEL_MESSAGE = "image has no matching YOLO label file"
ORPHAN_LABEL = "orphan_yolo_label"
ORPHAN_LABEL_MESSAGE = "label has no matching image file"
READ_FAILED = "label_read_failed"

#: Report order of the rules; labels come after them, file by file.
RULE_ORDER = (NO_IMAGES, MISSING_NAMES, MISSING_LABEL, ORPHAN_LABEL)


def finding(df: DataFrame, severity: str | Column, code: str | Column, **columns: Column) -> DataFrame:
    """Rows of the findings table; keys that a rule does not report stay NULL."""

    def col(value: str | Column) -> Column:
        return F.lit(value) if isinstance(value, str) else value

    types = dict(part.split() for part in FINDINGS.split(", "))
    values = {"dataset_id": F.col("dataset_id"), "severity": col(severity), "code": col(code)}
    values.update({k: col(v) for k, v in columns.items()})
    return df.select(
        *[values.get(name, F.lit(None)).cast(types[name]).alias(name) for name in FINDING_COLUMNS]
    )


def is_yolo() -> Column:
    return F.lower(strip(F.col("format"))) == "yolo"


def dataset_rules(datasets: DataFrame, files: DataFrame, classes: DataFrame) -> DataFrame:
    """The rules that ask one question of a whole dataset, from one pass over its files: it has
    images (below images/ for YOLO, anywhere for the other formats), and a YOLO dataset has class
    names or at least a class file."""
    path = F.col("relative_path")
    seen = files.groupBy("dataset_id").agg(
        F.count_if(is_image(path)).alias("anywhere"),
        F.count_if(is_dataset_image(path)).alias("below"),
        F.bool_or(is_class_file(path)).alias("class_file"),
    )
    named = classes.select("dataset_id").distinct().withColumn("named", F.lit(True))
    facts = datasets.join(seen, "dataset_id", "left").join(named, "dataset_id", "left")
    images = F.coalesce(F.when(is_yolo(), F.col("below")).otherwise(F.col("anywhere")), F.lit(0))
    nameless = ~F.coalesce("class_file", F.lit(False)) & ~F.coalesce("named", F.lit(False))
    found = F.array(
        _rule(images == 0, ERROR, NO_IMAGES, F.when(is_yolo(), NO_IMAGES_YOLO_MESSAGE).otherwise(NO_IMAGES_MESSAGE)),
        _rule(is_yolo() & nameless, WARNING, MISSING_NAMES, F.lit(MISSING_NAMES_MESSAGE)),
    )
    broken = facts.select("dataset_id", F.inline(F.filter(found, lambda r: r["broken"])))
    return finding(broken, F.col("severity"), F.col("code"), message=F.col("message"))


def _rule(broken: Column, severity: str, code: str, message: Column) -> Column:
    return F.struct(
        F.coalesce(broken, F.lit(False)).alias("broken"),
        F.lit(severity).alias("severity"),
        F.lit(code).alias("code"),
        message.alias("message"),
    )


def no_images(datasets: DataFrame, files: DataFrame) -> DataFrame:
    """Datasets without images."""
    nameless = datasets.select("dataset_id").limit(0)
    return dataset_rules(datasets, files, nameless).where(F.col("code") == NO_IMAGES)


def has_class_file(files: DataFrame) -> DataFrame:
    """Datasets whose manifest holds a class metadata file, even one without names."""
    return files.where(is_class_file(F.col("relative_path"))).select("dataset_id").distinct()


def missing_class_names(datasets: DataFrame, files: DataFrame, classes: DataFrame) -> DataFrame:
    """YOLO datasets with neither class names nor a class file."""
    return dataset_rules(datasets, files, classes).where(F.col("code") == MISSING_NAMES)


def _expected(files: DataFrame) -> DataFrame:
    path = F.col("relative_path")
    return files.where(is_dataset_image(path)).select(
        "dataset_id", path.alias("image"), expected_label_path(path).alias("label")
    )


def _present(files: DataFrame) -> DataFrame:
    """Label files. An expected path is always one of these, so no other file can match it."""
    path = F.col("relative_path")
    return files.where(is_label(path)).select("dataset_id", path.alias("label"))


def _missing_rows(unmatched: DataFrame) -> DataFrame:
    return finding(
        unmatched,
        WARNING,
        MISSING_LABEL,
        path=F.col("image"),
        expected_label_path=F.col("label"),
        message=MISSING_LABEL_MESSAGE,
    )


def _orphan_rows(unmatched: DataFrame) -> DataFrame:
    return finding(
        unmatched, WARNING, ORPHAN_LABEL, path=F.col("label"), message=ORPHAN_LABEL_MESSAGE
    )


def missing_labels(files: DataFrame) -> DataFrame:
    """Images whose label file is not in the manifest."""
    return _missing_rows(
        _expected(files).join(_present(files), ["dataset_id", "label"], "left_anti")
    )


def orphan_labels(files: DataFrame) -> DataFrame:
    """Label files that no image expects."""
    return _orphan_rows(
        _present(files).join(_expected(files), ["dataset_id", "label"], "left_anti")
    )


def label_pairing(files: DataFrame) -> DataFrame:
    """Both label rules from one pass: every image and label file meets at the label's path, and
    what stays alone there is reported.

    The key includes the path, so a hot dataset spreads over all tasks. The images that expect one
    label differ in their suffix only, so a list holds a handful.
    """
    path = F.col("relative_path")
    image = is_dataset_image(path)
    ends = files.where(image | is_label(path)).select(
        "dataset_id",
        F.when(image, expected_label_path(path)).otherwise(path).alias("label"),
        F.when(image, path).alias("image"),
    )
    met = ends.groupBy("dataset_id", "label").agg(
        F.collect_list("image").alias("images"), F.bool_or(F.col("image").isNull()).alias("present")
    )
    alone = met.where(~F.col("present") | (F.size("images") == 0))
    pairs = alone.select("dataset_id", "label", F.explode_outer("images").alias("image"))
    missing = F.col("image").isNotNull()
    return finding(
        pairs,
        WARNING,
        F.when(missing, MISSING_LABEL).otherwise(ORPHAN_LABEL),
        path=F.coalesce("image", "label"),
        expected_label_path=F.when(missing, F.col("label")),
        message=F.when(missing, MISSING_LABEL_MESSAGE).otherwise(ORPHAN_LABEL_MESSAGE),
    )


def _checked_lines(label_lines: DataFrame) -> DataFrame:
    """Non-blank lines with the facts the grammar needs.

    They come out of generators: Catalyst does not copy their input into later filters, so each
    search runs once per line however often its result is used.
    """
    lines = label_lines.where(~is_blank(F.col("raw")))
    raw, plain = F.col("raw"), F.col("plain")
    looked = lines.select("*", F.inline(F.array(line_facts(raw))))
    faults = F.struct(is_short(raw, plain).alias("short"), is_odd(raw, plain).alias("odd"))
    return looked.select("*", F.inline(F.array(faults)))


def parse_labels(label_lines: DataFrame) -> DataFrame:
    """Label lines with ``code``, ``message``, ``class_value``, ``class_id`` and ``coords``."""
    short, value = F.col("short"), class_value(F.col("odd"), F.col("first"))
    usable = ~short & value.isNotNull()
    return _checked_lines(label_lines).select(
        *[c for c in label_lines.columns if c != "raw"],
        label_code(short, value).alias("code"),
        label_message(short, value).alias("message"),
        F.when(usable, value).alias("class_value"),
        F.when(usable, value.try_cast("bigint")).alias("class_id"),
        F.when(usable, label_coords(F.col("raw"))).alias("coords"),
    )


def annotations(label_lines: DataFrame) -> DataFrame:
    """Valid label lines as class id and coordinates."""
    valid = parse_labels(label_lines).where(F.col("code").isNull())
    return valid.select("dataset_id", "path", "line", "class_id", "class_value", "coords")


def invalid_label_lines(label_lines: DataFrame) -> DataFrame:
    """Lines that break the label grammar or use a negative class."""
    bad = parse_labels(label_lines).where(F.col("code").isNotNull())
    return finding(
        bad, ERROR, F.col("code"), path=F.col("path"), line=F.col("line"), message=F.col("message")
    )


def check_class_range(parsed: DataFrame, class_counts: DataFrame) -> DataFrame:
    """Valid lines whose class lies beyond the dataset's names; no names, no check."""
    known = class_counts.where(F.col("class_count") > 0)
    ranged = lookup(parsed, known, "dataset_id", "inner")
    over = ranged.where(F.col("class_value") >= F.col("class_count"))
    return finding(
        over,
        WARNING,
        UNKNOWN_CLASS,
        path=F.col("path"),
        line=F.col("line"),
        class_id=F.col("class_id"),
        message=UNKNOWN_MESSAGE,
    )


def label_findings(label_lines: DataFrame, class_counts: DataFrame) -> DataFrame:
    """Grammar and class-range findings in one pass over the lines.

    ``class_counts`` has one row per dataset to check, with 0 where there are no names.
    """
    parsed = parse_labels(label_lines).drop("coords")
    checked = lookup(parsed, class_counts, "dataset_id", "inner")
    over = (F.col("class_count") > 0) & (F.col("class_value") >= F.col("class_count"))
    unknown = F.col("code").isNull() & over
    reported = checked.where(F.col("code").isNotNull() | unknown)
    return finding(
        reported,
        F.when(unknown, WARNING).otherwise(ERROR),
        F.when(unknown, UNKNOWN_CLASS).otherwise(F.col("code")),
        path=F.col("path"),
        line=F.col("line"),
        class_id=F.when(unknown, F.col("class_id")),
        message=F.when(unknown, UNKNOWN_MESSAGE).otherwise(F.col("message")),
    )


def findings(*rules: DataFrame) -> DataFrame:
    """All findings, with the two columns that give their report order inside a dataset."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rules)
    position = F.array_position(F.array(*[F.lit(c) for c in RULE_ORDER]), F.col("code"))
    by_label = (position == 0) | (F.col("code") == ORPHAN_LABEL)
    return merged.withColumn(
        "rule_order", F.when(by_label, len(RULE_ORDER)).otherwise(position).cast("int")
    ).withColumn("line_order", F.coalesce("line", F.lit(0)))


REPORT_ORDER = ("dataset_id", "rule_order", "path", "line_order")


def dataset_findings(
    datasets: DataFrame, files: DataFrame, classes: DataFrame, label_lines: DataFrame
) -> DataFrame:
    """Every rule over many datasets at once.

    Files are paired before the format is looked up: only unmatched ones meet the datasets then,
    and the manifest is shuffled for the pairing alone.
    """
    yolo = datasets.where(is_yolo()).select("dataset_id")
    unmatched = lookup(label_pairing(files), yolo, "dataset_id", "inner")
    named = classes.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        datasets.where(is_yolo())
        .join(named, "dataset_id", "left")
        .select("dataset_id", F.coalesce("n", F.lit(0)).alias("class_count"))
    )
    return findings(
        dataset_rules(datasets, files, classes),
        unmatched,
        label_findings(label_lines, counts),
    )


def finding_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("dataset_id").agg(
        F.count_if(F.col("severity") == ERROR).alias("error_count"),
        F.count_if(F.col("severity") == WARNING).alias("warning_count"),
    )


def verify_dataset(summary: DataFrame, found: DataFrame) -> DataFrame:
    """Summary with a verdict: any error fails a dataset, warnings never do.

    The findings stay rows of their own table; a list per dataset would grow with its files.
    """
    joined = summary.join(finding_counts(found), "dataset_id", "left")
    errors = F.coalesce("error_count", F.lit(0))
    return joined.select(
        *summary.columns,
        F.when(errors > 0, "failed").otherwise("ok").alias("status"),
        errors.alias("error_count"),
        F.coalesce("warning_count", F.lit(0)).alias("warning_count"),
    )
