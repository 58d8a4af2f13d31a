"""Queries over archives, imports and transfer telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import imports, ordering, parts, telemetry
from tidemark.plans.registry import query
from tidemark.plans.views import view

_SIZED = """(SELECT archive_id, total_bytes, CASE WHEN requested_mb > 0
    THEN greatest(5, requested_mb) * 1048576::BIGINT
    ELSE greatest(67108864, (total_bytes + 8999) // 9000) END AS ps FROM v_archives
  WHERE total_bytes > 0)"""
_PARTS = f"""(SELECT archive_id, i + 1 AS part_number, i * ps AS "offset",
    least(ps, total_bytes - i * ps) AS size_bytes
  FROM (SELECT *, unnest(generate_series(0::BIGINT, (total_bytes - 1) // ps)) AS i FROM {_SIZED}))"""
_TAG = "CASE WHEN (archive_id + part_number) % 11 = 0 THEN -part_number ELSE part_number END"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.part_ranges(view(spark, sf_dir, "v_archives"))


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload per planned part, some under a part number nobody planned; every third part was
    uploaded once before, under another tag."""
    number = F.col("part_number")
    stray = (F.col("archive_id") + number) % 11 == 0
    last = _parts(spark, sf_dir).select(
        "archive_id",
        F.when(stray, -number).otherwise(number).alias("part_number"),
        F.concat(F.lit("tag-"), number.cast("string")).alias("etag"),
        F.lit(2).alias("ordinal"),
    )
    before = last.where(number % 3 == 0).withColumns({"etag": F.lit("zz-old"), "ordinal": F.lit(1)})
    return last.unionByName(before)


@query("part_ranges", f"SELECT * FROM {_PARTS}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir)


@query(
    "empty_archives",
    "SELECT archive_id, 'archive is empty' AS message FROM v_archives WHERE total_bytes = 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.empty_archives(view(spark, sf_dir, "v_archives"))


@query(
    "sign_batches",
    f"""SELECT archive_id, part_number, CAST(floor((row_number() OVER (PARTITION BY archive_id
        ORDER BY part_number) - 1) / 8) AS BIGINT) AS batch_id FROM {_PARTS}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = parts.sign_batches(_parts(spark, sf_dir), 8)
    return batched.select("archive_id", "part_number", "batch_id")


@query(
    "number_parts",
    f"""SELECT archive_id, part_number, CAST(floor((row_number() OVER (PARTITION BY archive_id
        ORDER BY part_number) - 1) / 8) AS BIGINT) AS batch_id
      FROM (SELECT archive_id, {_TAG} AS part_number FROM {_PARTS})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    uploads = _uploads(spark, sf_dir).where("ordinal = 2").select("archive_id", "part_number")
    return parts.number_parts(uploads, 8).drop("row_index")


_ASSEMBLED = f"""SELECT archive_id, part_number, CASE WHEN (archive_id + part_number) % 11 <> 0
    THEN 'tag-' || part_number END AS etag, size_bytes FROM {_PARTS}"""


@query("assemble_parts", _ASSEMBLED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.assemble_parts(_parts(spark, sf_dir), _uploads(spark, sf_dir))


@query("missing_parts", f"SELECT archive_id, part_number FROM ({_ASSEMBLED}) WHERE etag IS NULL")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.missing_parts(
        parts.assemble_parts(_parts(spark, sf_dir), _uploads(spark, sf_dir))
    )


_MULTIPART = f"""SELECT archive_id, ps AS part_size_bytes, count(*) AS part_count,
    CAST(sum(size_bytes) AS BIGINT) AS total_bytes
  FROM {_SIZED} s JOIN {_PARTS} p USING (archive_id) GROUP BY 1, 2"""


@query("multipart_summary", _MULTIPART)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.multipart_summary(view(spark, sf_dir, "v_archives"))


@query(
    "summarise_parts",
    f"""SELECT archive_id, max(size_bytes) AS part_size_bytes, count(*) AS part_count,
        CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM {_PARTS} GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.summarise_parts(_parts(spark, sf_dir))


@query(
    "import_state_counts",
    """SELECT k.project_id, k.import_id, count(relative_path) AS total_files,
        count(*) FILTER (uploaded) AS uploaded_files, count(*) FILTER (streamed) AS streamed_files
      FROM (SELECT project_id, import_id FROM v_import_files
        UNION SELECT project_id, import_id FROM v_import_state) k
      LEFT JOIN v_import_files f ON k.project_id = f.project_id AND k.import_id = f.import_id
      GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.import_state_counts(
        view(spark, sf_dir, "v_import_files"), view(spark, sf_dir, "v_import_state")
    )


_LATEST = """SELECT * FROM v_import_listing WHERE import_id <> '' QUALIFY row_number() OVER
    (PARTITION BY project_id, import_id ORDER BY ordinal DESC) = 1"""


@query(
    "latest_server_imports",
    f"SELECT project_id, import_id, status, ordinal FROM ({_LATEST})",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = view(spark, sf_dir, "v_import_listing")
    return imports.latest_server_imports(
        listing.select("project_id", "import_id", "status", "ordinal")
    )


@query(
    "cleanup_actions",
    f"""SELECT s.project_id, 'remove_local_state' AS kind, state_path AS path,
        'server import is terminal and local resume state is completed' AS reason
      FROM v_import_state s JOIN ({_LATEST}) l
        ON s.project_id = l.project_id AND s.import_id = l.import_id
      WHERE completed AND lower(status) IN ('succeeded', 'success', 'completed', 'complete',
        'failed', 'error', 'cancelled', 'canceled')""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.cleanup_actions(
        view(spark, sf_dir, "v_import_state"), view(spark, sf_dir, "v_import_listing")
    )


@query(
    "latest_resume_state",
    """SELECT source, format, project_id, import_id, state_path FROM v_import_state
      WHERE import_id <> '' QUALIFY row_number() OVER (PARTITION BY source, format, project_id
        ORDER BY mtime DESC, state_path) = 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = imports.latest_resume_state(view(spark, sf_dir, "v_import_state"))
    return newest.select("source", "format", "project_id", "import_id", "state_path")


def _timing_check(keys: str) -> str:
    return f"""SELECT {keys}, "count", duration_sec, round(duration_sec / "count", 6)
        AS avg_duration_sec, max_duration_sec, file_count, byte_count,
        round(byte_count / 1048576.0::DOUBLE, 3) AS mib,
        CASE WHEN byte_count > 0 AND duration_sec > 0
          THEN round(byte_count / 1048576.0::DOUBLE / duration_sec, 3) END AS throughput_mibps
      FROM (SELECT {keys}, count(*) AS "count",
          round(CAST(sum(CAST(greatest(0, duration_sec) AS DECIMAL(18, 2))) AS DOUBLE), 6)
            AS duration_sec,
          max(greatest(0, duration_sec)) AS max_duration_sec,
          CAST(sum(file_count) AS BIGINT) AS file_count,
          CAST(sum(byte_count) AS BIGINT) AS byte_count
        FROM v_transfer_events GROUP BY {keys})"""


@query("timing_summary", _timing_check("name"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.timing_summary(view(spark, sf_dir, "v_transfer_events"))


@query("timing_summary_by_run", _timing_check("run_id, name"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.timing_summary(view(spark, sf_dir, "v_transfer_events"), ["run_id", "name"])


@query(
    "name_order",
    f"""SELECT name, file_count, row_number() OVER (ORDER BY name) - 1 AS position
      FROM ({_timing_check('name')})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = telemetry.timing_summary(view(spark, sf_dir, "v_transfer_events"))
    return ordering.name_order(summed.select("name", "file_count"))


FIRST_N_CHECK = """
    SELECT run_id, 512::BIGINT AS target_files, bool_or(total >= 512) AS reached,
      round((epoch_us(min(ts) FILTER (total >= 512)) - epoch_us(min(ts))) / 1e6, 3) AS elapsed_sec,
      CAST(coalesce(min(total) FILTER (total >= 512), max(total)) AS BIGINT) AS accepted_files
    FROM (SELECT run_id, ts, sum(greatest(0, file_count)) OVER (PARTITION BY run_id
            ORDER BY ts, event_id) AS total FROM v_transfer_events)
    GROUP BY 1 HAVING max(total) > 0"""


@query("first_n_accepted", FIRST_N_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.first_n_accepted(view(spark, sf_dir, "v_transfer_events"))


def _progress_check(keys: str) -> str:
    return f"""SELECT run_id, batch_id, event_id, CAST(files AS BIGINT) AS done_files,
        CAST(bytes AS BIGINT) AS done_bytes, round(bytes / 1048576.0::DOUBLE, 1) AS done_mib,
        round(bytes / 1048576.0::DOUBLE / greatest(0.001, (epoch_us(ts) - epoch_us(started)) / 1e6),
          2) AS mib_per_sec
      FROM (SELECT *, sum(file_count) OVER w AS files, sum(byte_count) OVER w AS bytes,
          min(ts) OVER (PARTITION BY {keys}) AS started FROM v_transfer_events
        WINDOW w AS (PARTITION BY {keys} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))"""


@query("transfer_progress", _progress_check("run_id, batch_id"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.transfer_progress(view(spark, sf_dir, "v_transfer_events"))


@query("archive_progress", _progress_check("run_id"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.transfer_progress(view(spark, sf_dir, "v_transfer_events"), False)
