"""Resume-state documents and import listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.refs import compact_import
from tidemark.functions.text import decode_utf8
from tidemark.schemas import IMPORT_STATE
from tidemark.shared import write_and_read
from tidemark.sources.filetree import as_store, read_content
from tidemark.sources.stores import Store
from tidemark.sources.tree_source import tree_files

_HEADER = (
    "struct<project_id:string,import_id:string,source:string,format:string,task_key:string,"
    "files:map<string,string>>"
)
_ENTRY = (
    "struct<object_key:string,sha256:string,size_bytes:bigint,width:int,height:int>"
)


def _documents(spark: SparkSession, root: str | Store, project: str | None = None) -> DataFrame:
    """JSON files exactly one folder below ``root``, as text. One listing for all of them, in tasks; of
    other projects' folders nothing is listed. Files that cannot be read have NULL text."""
    store = as_store(root)
    base = store.root.removeprefix("file://").removeprefix("file:") if store.mounted else store.root
    files = tree_files(spark, store)
    if project is not None:
        files = files.where(F.col("relative_path").startswith(f"{project}/"))
    files = files.where(F.col("relative_path").endswith(".json") & F.col("relative_path").rlike(r"^[^/]+/[^/]+\z"))
    return read_content(files, store).select(
        F.concat(F.lit(f"{base.rstrip('/')}/"), "relative_path").alias("path"),
        F.col("modified").alias("mtime"),
        decode_utf8(F.col("content")).alias("text"),
    )


def is_json_object(text: Column) -> Column:
    """True for one well-formed JSON object, false for anything else."""
    # Its first sign tells the kind of a well-formed value; a schema would walk through all that is in it.
    return F.coalesce(text.rlike(r"\A[ \t\r\n]*\{"), F.lit(False)) & F.try_parse_json(text).isNotNull()


def is_truthy(value: Column) -> Column:
    """Whether a JSON value (variant) counts as yes: all but null, false, zero and what is empty.
    NULL where there is no value."""
    text = F.to_json(value)
    nothing = text.isin("null", "false", '""', "[]", "{}")
    return ~nothing & ~F.coalesce(text.try_cast("double") == 0, F.lit(False))


def state_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header and file rows of resume states (``path``, ``mtime``, ``text``). Documents that are
    not JSON objects are skipped; an entry that is not an object keeps NULL flags."""
    parsed = documents.where(is_json_object(F.col("text"))).select(
        F.col("path").alias("state_path"),
        "mtime",
        F.from_json("text", _HEADER).alias("s"),
        is_truthy(F.try_variant_get(F.try_parse_json("text"), "$.completed", "variant")).alias("done"),
    )
    texts = ("project_id", "import_id", "source", "format")
    header = parsed.select(
        *[F.coalesce(F.col(f"s.{c}"), F.lit("")).alias(c) for c in texts],
        F.col("s.task_key").alias("task_key"),
        F.coalesce("done", F.lit(False)).alias("completed"),
        "state_path",
        "mtime",
    )
    entries = parsed.select(
        *[F.coalesce(F.col(f"s.{c}"), F.lit("")).alias(c) for c in ("project_id", "import_id")],
        F.explode("s.files").alias("relative_path", "value"),
    )
    is_object = F.col("value").startswith("{")
    flagged = entries.withColumns(
        {
            "e": F.when(is_object, F.from_json("value", _ENTRY)),
            "v": F.when(is_object, F.try_parse_json("value")),
        }
    )
    files = flagged.select(
        "project_id",
        "import_id",
        "relative_path",
        *[
            is_truthy(F.try_variant_get("v", f"$.{flag}", "variant")).alias(flag)
            for flag in ("uploaded", "streamed")
        ],
        F.nullif("e.object_key", F.lit("")).alias("object_key"),
        F.nullif("e.sha256", F.lit("")).alias("sha256"),
        F.col("e.size_bytes").alias("size_bytes"),
        F.nullif("e.width", F.lit(0)).alias("width"),
        F.nullif("e.height", F.lit(0)).alias("height"),
    )
    names = [part.split()[0] for part in IMPORT_STATE.split(", ")]
    return header.select(*names), files


def read_import_states(
    spark: SparkSession, state_dir: str, project_segment: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """States below ``<state_dir>/<project>/*.json``, of one project folder or of all."""
    return state_documents(_documents(spark, state_dir, project_segment))


def page_ranks(pages: DataFrame) -> DataFrame:
    """(project_id, path, chain, rank) of the pages that their cursors link: where a page stands in its
    chain, and when the chain's first page landed.

    A page says in ``cursor`` what it was asked with and in ``next_cursor`` what comes after it. The page
    before a page is the last landed one whose ``next_cursor`` is its ``cursor``. Places are found by
    pointer doubling: each round doubles how far a page looks back, so a chain of n pages takes log n
    rounds. Pages whose cursors lead in a circle, and pages without links, are left out. Runs a job for
    each round when called, unless no page has a cursor.
    """
    keys = ["project_id", "path"]
    cursors = F.from_json("text", "struct<cursor:string,next_cursor:string>")
    seen = pages.select(*keys, "mtime", cursors["cursor"].alias("cursor"), cursors["next_cursor"].alias("next_cursor"))
    seen = write_and_read(seen.where("cursor IS NOT NULL OR next_cursor IS NOT NULL"), "pages")
    before = seen.where("next_cursor IS NOT NULL").groupBy("project_id", F.col("next_cursor").alias("cursor")).agg(
        F.max_by("path", F.struct("mtime", "path")).alias("back")
    )
    links = seen.join(before, ["project_id", "cursor"], "left").select(
        *keys, "back", F.coalesce("back", "path").alias("first"), F.col("back").isNotNull().cast("long").alias("rank")
    )
    rounds = links.count().bit_length()
    for _ in range(rounds):
        links = write_and_read(links, "pages")
        if links.where("back IS NOT NULL").isEmpty():
            break
        further = links.select(
            "project_id", F.col("path").alias("back"), F.col("back").alias("back2"), F.col("first").alias("first2"), F.col("rank").alias("rank2")
        )
        links = links.join(further, ["project_id", "back"], "left").select(
            *keys,
            F.col("back2").alias("back"),
            F.coalesce("first2", "first").alias("first"),
            (F.col("rank") + F.coalesce("rank2", F.lit(0))).alias("rank"),
        )
    settled = links.where("back IS NULL")
    chains = settled.groupBy("project_id", "first").agg(F.max("rank").alias("last")).where("last > 0")
    landed = seen.select("project_id", F.col("path").alias("first"), F.col("mtime").alias("chain"))
    of_chain = settled.join(chains, ["project_id", "first"]).join(landed, ["project_id", "first"])
    return of_chain.select(*keys, "chain", "rank")


def listed_imports(pages: DataFrame) -> DataFrame:
    """Entries of landed listing pages (``project_id``, ``path``, ``mtime``, ``text``), all pages.

    Entries that are not objects are dropped. ``ordinal`` follows the pages' cursors
    (:func:`page_ranks`), later chains after earlier ones. Pages without linked cursors come first, by the
    number that their name ends with, so page 10 comes after page 9, then by the time they landed.
    """
    number = F.regexp_extract("path", r"([0-9]+)[^0-9/]*$", 1).try_cast("decimal(38,0)")
    placed = pages.join(page_ranks(pages), ["project_id", "path"], "left")
    entries = placed.select(
        "project_id",
        "path",
        "mtime",
        "chain",
        "rank",
        F.coalesce(number, F.lit(0)).alias("page"),
        F.posexplode(F.from_json("text", "struct<imports:array<string>>")["imports"]),
    )
    kept = entries.where(F.col("col").startswith("{"))
    ordinal = F.struct("chain", "rank", "page", "mtime", "path", "pos").alias("ordinal")
    compact = kept.select("project_id", ordinal, F.inline(compact_import(F.col("col"))))
    return compact.select("project_id", *compact.columns[2:], "ordinal")


def read_server_imports(
    spark: SparkSession, listing_dir: str, project_segment: str | None = None
) -> DataFrame:
    """Listing pages landed as ``<listing_dir>/<project>/*.json``, of one project folder or of all."""
    pages = _documents(spark, listing_dir, project_segment)
    project = F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    return listed_imports(pages.select(project.alias("project_id"), "path", "mtime", "text"))
