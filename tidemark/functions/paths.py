"""Predicates and rewrites on dataset-relative POSIX paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.mime_types import COMPRESSED, SUFFIXES, TYPES

# Class metadata names in the order they are looked up.
CLASS_FILES = ("data.yaml", "data.yml", "dataset.yaml", "dataset.yml", "classes.txt")
# Fixed value: file name endings that make an image.
IMAGE_PATTERN = r"(?i)[^/]\.(jpg|jpeg|png|bmp|webp)\z"
DEFAULT_CONTENT_TYPE = "application/octet-stream"
#: Directory holding resume states; callers with another layout pass their own name.
STATE_DIR = ".transfer-state"

_EXTENSION = r"[^/.][^/]*(\.[^/.]*)\z"
_LAST_SUFFIX = r"([^/])\.[^./]+\z"


def relative_path(root: Column | str, path: Column) -> Column:
    """Path relative to ``root``; a ``file:`` scheme on either side is ignored."""
    base = F.lit(root) if isinstance(root, str) else root
    scheme = r"^file:(//)?(?=/)"
    clean_root = F.regexp_replace(F.regexp_replace(base, scheme, ""), "(?<=.)/+$", "")
    clean_path = F.regexp_replace(path, scheme, "")
    return F.substr(clean_path, F.length(clean_root) + 2)


def is_image(path: Column) -> Column:
    return path.rlike(IMAGE_PATTERN)


def is_dataset_image(path: Column) -> Column:
    """Image below ``images/``: the only images that labels belong to."""
    return path.startswith("images/") & is_image(path)


def is_label(path: Column) -> Column:
    return path.startswith("labels/") & path.endswith(".txt")


def expected_label_path(path: Column) -> Column:
    stem = F.regexp_replace(path, _LAST_SUFFIX, "$1")
    moved = F.concat(F.lit("labels/"), F.substr(stem, F.lit(len("images/") + 1)))
    return F.concat(F.when(stem.startswith("images/"), moved).otherwise(stem), F.lit(".txt"))


def not_state_dir(path: Column, state_dir: str = STATE_DIR) -> Column:
    """False when any path component is the state directory."""
    return ~F.concat(F.lit("/"), path, F.lit("/")).contains(f"/{state_dir}/")


def is_class_file(path: Column) -> Column:
    return path.isin(*CLASS_FILES)


def is_sample_metadata(path: Column) -> Column:
    """Files every sample keeps: class metadata and JSON files at the root."""
    return is_class_file(path) | (path.endswith(".json") & ~path.contains("/"))


def component_order(path: Column) -> Column:
    """Sort key that compares paths component by component.

    NUL sorts below every character and cannot occur in a file name, so the plain string order of
    this key puts ``a/b`` before ``a-b``.
    """
    return F.replace(path, F.lit("/"), F.lit("\x00"))


def string_order(path: Column) -> Column:
    """Sort key for code-point order of the whole path, which is Spark's own string order."""
    return path


def safe_segment(value: Column) -> Column:
    """Text usable as one path component."""
    cleaned = F.regexp_replace(value, r"[^\p{L}\p{N}_.-]", "_")
    trimmed = F.regexp_replace(cleaned, r"^[._]+|[._]+\z", "")
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("default"))


def _map_value(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(text) for item in table.items() for text in item]
    return F.try_element_at(F.create_map(*pairs), key)


def content_type(path: Column) -> Column:
    """MIME type by extension, from the table kept with this package.

    A compression suffix is removed first, so ``x.tar.gz`` is a tar and a lone ``x.gz`` unknown.
    """
    expanded = path
    for short, full in SUFFIXES.items():
        expanded = F.regexp_replace(
            expanded, rf"(?i)([^/.][^/]*){short.replace('.', '[.]')}\z", f"$1{full}"
        )
    # Written as one pattern: the suffixes above are rare and regexes over every path are not free.
    any_short = "|".join(s.lstrip(".") for s in SUFFIXES)
    expanded = F.when(path.rlike(rf"(?i)\.({any_short})\z"), expanded).otherwise(path)
    packed = "|".join(s.lstrip(".") for s in COMPRESSED)
    plain = F.regexp_replace(expanded, rf"([^/.][^/]*)\.({packed})\z", "$1")
    extension = F.lower(F.regexp_extract(plain, _EXTENSION, 1))
    return F.coalesce(_map_value(TYPES, extension), F.lit(DEFAULT_CONTENT_TYPE))
