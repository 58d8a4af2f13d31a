"""Label text and class metadata."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import is_blank, split_lines
from tidemark.functions.paths import CLASS_FILES, is_class_file
from tidemark.operators.classes import compact_class_ids
from tidemark.operators.verify import ERROR, READ_FAILED, finding

INVALID_METADATA = "invalid_class_metadata"
_KEYED_NAMES = "struct<names:array<struct<name_key:bigint,raw_name:string>>,error:string>"


def read_label_lines(texts: DataFrame) -> DataFrame:
    """Non-blank lines of ``text`` with their 1-based number; blank lines are counted."""
    lines = texts.select("dataset_id", "path", F.posexplode(split_lines(F.col("text"))))
    return lines.where(~is_blank(F.col("col"))).select(
        "dataset_id",
        "path",
        (F.col("pos") + 1).cast("bigint").alias("line"),
        F.col("col").alias("raw"),
    )


def unreadable_labels(texts: DataFrame) -> DataFrame:
    """Label files whose text is missing or not UTF-8."""
    return finding(
        texts.where(F.col("text").isNull()),
        ERROR,
        READ_FAILED,
        path=F.col("path"),
        message="label file cannot be read as UTF-8 text",
    )


def select_class_metadata(files: DataFrame) -> DataFrame:
    """The class metadata file of each dataset: the first name of the list that exists, whether
    or not it turns out to hold names."""
    path = F.col("relative_path")
    priority = F.array_position(F.array(*[F.lit(n) for n in CLASS_FILES]), path)
    return (
        files.where(is_class_file(path))
        .groupBy("dataset_id")
        .agg(F.min_by(path, priority).alias("relative_path"))
    )


def _keyed(index: object, name: object) -> dict[str, object]:
    return {"name_key": index, "raw_name": str(name)}


def _names_of(text: str | None) -> dict[str, object]:
    """Names of one YAML document as (key, name) pairs, or the reason there are none."""
    import yaml

    if text is None:
        return {"names": [], "error": "metadata is not UTF-8 text"}
    try:
        root = yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    except (yaml.YAMLError, ValueError):
        return {"names": [], "error": "document cannot be parsed as YAML"}
    if not isinstance(root, dict):
        return {"names": [], "error": "top level of the document holds no keys"}
    names = root.get("names")
    if names is None:
        return {"names": [], "error": None}
    if isinstance(names, list):
        pairs = [_keyed(i, name) for i, name in enumerate(names)]
    elif isinstance(names, dict):
        try:
            pairs = [_keyed(int(key), name) for key, name in names.items()]
        except (TypeError, ValueError):
            return {"names": [], "error": "a key of names is not an integer"}
    else:
        return {"names": [], "error": "names is neither list nor mapping"}
    kept = [p for p in pairs if str(p["raw_name"]).strip()]
    error = None if kept else "names are empty"
    if kept and root.get("nc") is not None:
        try:
            expected = int(root["nc"])
            if expected != len(kept):
                error = f"nc is {expected} but there are {len(kept)} names"
        except (TypeError, ValueError):
            error = "nc is not an integer"
    return {"names": [] if error else kept, "error": error}


def _yaml_names(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([_names_of(t) for t in batch], columns=["names", "error"])


def _listed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("path").endswith(".txt"))


def _yaml_parsed(documents: DataFrame) -> DataFrame:
    """YAML documents with ``names`` (keyed, unordered) and ``error``: the only Python here."""
    parse = F.pandas_udf(_yaml_names, _KEYED_NAMES)
    return (
        documents.where(~F.col("path").endswith(".txt"))
        .withColumn("_parsed", parse("text"))
        .select("dataset_id", "path", "_parsed.names", "_parsed.error")
    )


def class_names(documents: DataFrame) -> DataFrame:
    """Keyed names of metadata documents, one row per name; the key of a listed name is its line."""
    lines = read_label_lines(_listed(documents)).select(
        "dataset_id", F.col("line").alias("name_key"), F.col("raw").alias("raw_name")
    )
    named = _yaml_parsed(documents).where(F.col("error").isNull())
    return lines.unionByName(named.select("dataset_id", F.inline("names")))


def metadata_problems(documents: DataFrame) -> DataFrame:
    """Findings for documents that cannot be used."""
    text = F.col("text")
    reason = F.when(text.isNull(), "metadata is not UTF-8 text").when(
        is_blank(text), F.concat("path", F.lit(" is empty"))
    )
    empty = _listed(documents).select("dataset_id", "path", reason.alias("error"))
    problems = empty.unionByName(_yaml_parsed(documents).drop("names"))
    return finding(
        problems.where(F.col("error").isNotNull()),
        ERROR,
        INVALID_METADATA,
        path=F.col("path"),
        message=F.col("error"),
    )


def class_catalog(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Class table of metadata documents (``dataset_id``, ``path``, ``text``), one per dataset,
    and findings for those that cannot be used."""
    return compact_class_ids(class_names(documents)), metadata_problems(documents)
