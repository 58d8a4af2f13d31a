"""Result documents and listing entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import PROGRESS

# References lifted to the top of a result.
REF_KEYS = ("dataset_manifest_ref", "artifact_ref", "result_manifest_ref", "read_lease")
# Where a reference may be, first place wins.
REF_PLACES = ("complete", "multipart.complete", "job")

IMPORT_ENTRY = (
    "struct<import_id:string,status:string,source:string,format:string,file_count:bigint,"
    f"image_count:bigint,created_at:string,updated_at:string,progress:{PROGRESS}>"
)


def promote_ref(*places: Column) -> Column:
    """First place that holds the reference."""
    return F.coalesce(*places)


def promote_refs(result_json: Column) -> Column:
    """Struct with one JSON object per reference of a result document, NULL where absent.

    Only objects count: a string or number under the same name is passed over.
    """
    document = F.try_parse_json(result_json)

    def object_at(path: str) -> Column:
        found = F.try_variant_get(document, f"$.{path}", "variant")
        return F.when(F.schema_of_variant(found).startswith("OBJECT"), F.to_json(found))

    return F.struct(
        *[
            promote_ref(
                object_at(key), *[object_at(f"{place}.{key}") for place in REF_PLACES]
            ).alias(key)
            for key in REF_KEYS
        ]
    )


def compact_import(entry_json: Column) -> Column:
    """Listing entry reduced to its known keys. Ids and status are text, '' when absent.

    An array of one struct, to be taken out with ``inline``: behind a generator the entry is parsed
    once, however many of its fields are used.
    """
    parsed = F.array(F.from_json(entry_json, IMPORT_ENTRY))
    return F.transform(parsed, _compacted)


def _compacted(entry: Column) -> Column:
    return F.struct(
        F.coalesce(entry["import_id"], F.lit("")).alias("import_id"),
        F.coalesce(entry["status"], F.lit("")).alias("status"),
        *[
            entry[name].alias(name)
            for name in (
                "source",
                "format",
                "file_count",
                "image_count",
                "created_at",
                "updated_at",
                "progress",
            )
        ],
    )


def content_sha256(content: Column) -> Column:
    """Lower-case hex SHA-256."""
    return F.sha2(content, 256)
