"""Resume states against the imports a service lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.status import is_terminal
from tidemark.operators.ordering import last_wins

IMPORT_KEYS = ("project_id", "import_id")
# The one cleanup action.
REMOVE_STATE = "remove_local_state"
REMOVE_REASON = "server import is terminal and local resume state is completed"


COUNTS = ("total_files", "uploaded_files", "streamed_files")


def import_state_counts(import_files: DataFrame, import_state: DataFrame | None = None) -> DataFrame:
    """Files per import: all, uploaded, streamed. Entries without flags count only in the total.
    With the headers in ``import_state``, imports without files are there too, with zeros."""
    counts = import_files.groupBy(*IMPORT_KEYS).agg(
        F.count(F.lit(1)).alias(COUNTS[0]),
        F.count_if(F.col("uploaded")).alias(COUNTS[1]),
        F.count_if(F.col("streamed")).alias(COUNTS[2]),
    )
    if import_state is None:
        return counts
    every = import_state.select(*IMPORT_KEYS).distinct().join(counts, list(IMPORT_KEYS), "full")
    return every.select(*IMPORT_KEYS, *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])


def latest_server_imports(server_imports: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Last listed entry per import; entries without an id are dropped."""
    named = server_imports.where(F.coalesce("import_id", F.lit("")) != "")
    return last_wins(named, IMPORT_KEYS, ordinal)


def cleanup_actions(
    import_state: DataFrame, server_imports: DataFrame, ordinal: str = "ordinal"
) -> DataFrame:
    """States that can go: completed here and terminal there. A proposal, nothing is removed."""
    latest = latest_server_imports(
        server_imports.select(*IMPORT_KEYS, "status", ordinal), ordinal
    ).where(is_terminal(F.col("status")))
    finished = import_state.where(F.col("completed"))
    return finished.join(latest.select(*IMPORT_KEYS), list(IMPORT_KEYS), "left_semi").select(
        "project_id",
        F.lit(REMOVE_STATE).alias("kind"),
        F.col("state_path").alias("path"),
        F.lit(REMOVE_REASON).alias("reason"),
    )


def latest_resume_state(
    import_state: DataFrame,
    source: str | None = None,
    fmt: str | None = None,
    project_id: str | None = None,
) -> DataFrame:
    """Newest state with an import id per (source, format, project), or for the one asked for.

    Equal times go to the first path.
    """
    usable = import_state.where(F.coalesce("import_id", F.lit("")) != "")
    for name, value in (("source", source), ("format", fmt), ("project_id", project_id)):
        if value is not None:
            usable = usable.where(F.col(name) == value)
    keys = ["source", "format", "project_id"]
    rest = [c for c in import_state.columns if c not in keys]
    newest_first = F.struct(-F.unix_micros("mtime"), "state_path")
    kept = usable.groupBy(*keys).agg(F.min_by(F.struct(*rest), newest_first).alias("_kept"))
    return kept.select(*keys, "_kept.*").select(*import_state.columns)
