"""Queries over the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import labels, paths, refs, sizes, status, urls
from tidemark.operators.verify import parse_labels
from tidemark.plans.registry import query
from tidemark.plans.views import STATE_DIR, view

def _on_files(
    spark: SparkSession, sf_dir: str, function: Callable[[Column], Column], name: str
) -> DataFrame:
    files = view(spark, sf_dir, "v_files")
    value = function(F.col("relative_path"))
    return files.select("dataset_id", "relative_path", value.alias(name))


@query(
    "relative_path",
    "SELECT file_no, relative_path AS path FROM v_files",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.concat(F.lit("file:///data/sets/"), "dataset_id", F.lit("/"), "relative_path")
    root = F.concat(F.lit("/data/sets/"), "dataset_id", F.lit("/"))
    return view(spark, sf_dir, "v_files").select(
        "file_no", paths.relative_path(root, full).alias("path")
    )


@query(
    "content_type",
    r"""SELECT dataset_id, relative_path,
        CASE WHEN regexp_matches(relative_path, '(^|/)\.[^/]*$')
               AND NOT regexp_matches(relative_path, '[^/.][^/]*\.[^/]*$')
             THEN 'application/octet-stream'
             WHEN lower(relative_path) LIKE '%.jpg' THEN 'image/jpeg'
             WHEN lower(relative_path) LIKE '%.png' THEN 'image/png'
             WHEN lower(relative_path) LIKE '%.webp' THEN 'image/webp'
             WHEN lower(relative_path) LIKE '%.txt' THEN 'text/plain'
             WHEN lower(relative_path) LIKE '%.json' THEN 'application/json'
             WHEN lower(relative_path) LIKE '%.tar.gz' THEN 'application/x-tar'
             ELSE 'application/octet-stream' END AS content_type
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, paths.content_type, "content_type")


@query(
    "is_image",
    r"""SELECT dataset_id, relative_path,
        list_contains(['jpg', 'jpeg', 'png', 'bmp', 'webp'],
          lower(regexp_extract(relative_path, '[^/]\.([^./]+)$', 1))) AS is_image
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, paths.is_image, "is_image")


@query(
    "is_label",
    "SELECT dataset_id, relative_path, relative_path LIKE 'labels/%.txt' AS is_label FROM v_files",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, paths.is_label, "is_label")


@query(
    "expected_label_path",
    r"""SELECT dataset_id, relative_path,
        CASE WHEN stem LIKE 'images/%' THEN 'labels/' || substr(stem, 8) ELSE stem END || '.txt'
          AS label_path
      FROM (SELECT *, regexp_replace(relative_path, '([^/])\.[^./]+$', '\1') AS stem FROM v_files)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, paths.expected_label_path, "label_path")


@query(
    "not_state_dir",
    f"""SELECT dataset_id, relative_path,
        NOT list_contains(string_split(relative_path, '/'), '{STATE_DIR}') AS kept
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, lambda p: paths.not_state_dir(p, STATE_DIR), "kept")


@query(
    "is_class_file",
    """SELECT dataset_id, relative_path, relative_path IN
        ('data.yaml', 'data.yml', 'dataset.yaml', 'dataset.yml', 'classes.txt') AS is_class_file
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, paths.is_class_file, "is_class_file")


@query(
    "is_sample_metadata",
    """SELECT dataset_id, relative_path, relative_path IN
        ('data.yaml', 'data.yml', 'dataset.yaml', 'dataset.yml', 'classes.txt')
        OR (relative_path LIKE '%.json' AND strpos(relative_path, '/') = 0) AS is_metadata
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_files(spark, sf_dir, paths.is_sample_metadata, "is_metadata")


@query(
    "import_status_class",
    """SELECT project_id, import_id, entry_no, ordinal,
        CASE WHEN trim(lower(status)) IN
            ('succeeded', 'success', 'completed', 'complete', 'ready', 'done') THEN 'success'
          WHEN trim(lower(status)) IN ('failed', 'error', 'cancelled', 'canceled') THEN 'failed'
          ELSE 'pending' END AS status_class
      FROM v_import_listing""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = view(spark, sf_dir, "v_import_listing")
    value = status.import_status_class(F.col("status")).alias("status_class")
    return listing.select("project_id", "import_id", "entry_no", "ordinal", value)


@query(
    "is_terminal",
    """SELECT project_id, import_id, entry_no, ordinal,
        lower(status) IN ('succeeded', 'success', 'completed', 'complete', 'failed', 'error',
          'cancelled', 'canceled') AS terminal
      FROM v_import_listing""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = view(spark, sf_dir, "v_import_listing")
    value = status.is_terminal(F.col("status")).alias("terminal")
    return listing.select("project_id", "import_id", "entry_no", "ordinal", value)


@query(
    "safe_segment",
    """SELECT c_custkey, coalesce(nullif(trim(regexp_replace(raw, '[^A-Za-z0-9_.-]', '_', 'g'),
          '._'), ''), 'default') AS segment
      FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '..' || c_name || '/x_.'
              WHEN 1 THEN c_name || ' ' || c_mktsegment WHEN 2 THEN '_._' ELSE c_name END AS raw
            FROM customer)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr(
        "CASE c_custkey % 5 WHEN 0 THEN '..' || c_name || '/x_.' "
        "WHEN 1 THEN c_name || ' ' || c_mktsegment WHEN 2 THEN '_._' ELSE c_name END"
    )
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customers.select("c_custkey", paths.safe_segment(raw).alias("segment"))


@query(
    "resolve_url",
    r"""SELECT page_id,
        CASE WHEN text NOT LIKE '/%' THEN text
          WHEN regexp_matches(base, '(?i)^https?://[^/?#]+')
            THEN regexp_replace(regexp_extract(base, '^[^/]*//[^/?#]+'), '^HTTPS', 'https') || text
          END AS resolved
      FROM (SELECT page_id, base, trim(raw_url) AS text FROM v_urls)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = urls.resolve_url(F.col("base"), F.col("raw_url")).alias("resolved")
    return view(spark, sf_dir, "v_urls").select("page_id", value)


@query(
    "rewrite_origin",
    r"""SELECT page_id,
        CASE WHEN page_id % 5 = 0 THEN url
          WHEN page_id % 5 = 1 THEN 'http://127.0.0.1:9000' || rest
          WHEN page_id % 5 = 2 THEN 'https://Mirror.example.org' || rest
          WHEN page_id % 5 = 4 THEN 'http://10.0.0.1' || rest END AS new_url,
        CASE WHEN page_id % 5 IN (1, 2, 4) THEN regexp_extract(url, '//([^/?#]+)', 1) END AS host
      FROM (SELECT page_id, url, regexp_extract(url, '^[^/]*//[^/?#]+(.*)$', 1) AS rest FROM v_urls)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = urls.rewrite_origin(F.col("url"), F.col("origin"))
    return view(spark, sf_dir, "v_urls").select(
        "page_id", moved["url"].alias("new_url"), moved["host"].alias("host")
    )


@query(
    "host_in_domains",
    r"""SELECT page_id,
        regexp_matches(lower(base), '^https?://([^/@]*@)?([a-z0-9.-]*\.)?example\.com(:[0-9]+)?(/|$)')
          AS base_direct,
        regexp_matches(lower(url), '^https?://([a-z0-9-]+\.)*example\.com(:[0-9]+)?(/|$)')
          AS url_direct
      FROM v_urls""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = ["Example.com ", "storage"]
    return view(spark, sf_dir, "v_urls").select(
        "page_id",
        urls.host_in_domains(F.col("base"), domains).alias("base_direct"),
        urls.host_in_domains(F.col("url"), domains).alias("url_direct"),
    )


@query(
    "is_transient_status",
    """SELECT event_id, http_status IN (408, 429, 500, 502, 503, 504) AS transient
      FROM v_transfer_events""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = status.is_transient_status(F.col("http_status")).alias("transient")
    return view(spark, sf_dir, "v_transfer_events").select("event_id", value)


@query(
    "retry_delay",
    """SELECT event_id, least(15.0, 0.8 * pow(2, attempt))::DOUBLE AS json_delay,
        least(30.0, 2.0 * (attempt + 1))::DOUBLE AS complete_delay,
        least(30.0, greatest(0.1, 0.25) * pow(2, attempt - 1))::DOUBLE AS put_delay
      FROM v_transfer_events""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempt = F.col("attempt")
    return view(spark, sf_dir, "v_transfer_events").select(
        "event_id",
        status.retry_delay("json", attempt).alias("json_delay"),
        status.retry_delay("batch_complete", attempt).alias("complete_delay"),
        status.retry_delay("put", attempt).alias("put_delay"),
    )


_FAILURE_TEXT = """CASE event_id % 6 WHEN 0 THEN 'TOKEN_EXPIRED' WHEN 1 THEN 'curl: The requested URL
 returned error: 401' WHEN 2 THEN 'Unauthorized' WHEN 3 THEN NULL ELSE 'timeout ' || props END"""


@query(
    "is_auth_failure",
    f"""SELECT event_id, http_status IN (401, 403) OR coalesce(contains(t, 'token_expired')
          OR contains(t, 'unauthorized') OR contains(t, 'returned error: 401'), false) AS auth
      FROM (SELECT v.event_id, http_status, lower(text) AS t FROM v_transfer_events v JOIN
            (SELECT event_id, {_FAILURE_TEXT} AS text FROM events) e ON v.event_id = e.event_id)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.expr(_FAILURE_TEXT).alias("text")
    )
    events = view(spark, sf_dir, "v_transfer_events").join(texts, "event_id")
    value = status.is_auth_failure(F.col("http_status"), F.col("text")).alias("auth")
    return events.select("event_id", value)


_DETAIL = """CASE event_id % 4
  WHEN 0 THEN '{"error":{"message":" m' || event_id || ' ","correlation_id":"c' || user_id || '"}}'
  WHEN 1 THEN '{"error":{"message":""}}' WHEN 2 THEN ' plain ' || props ELSE '' END"""


@query(
    "error_message",
    f"""SELECT event_id, 'Error: ' || CASE event_id % 4 WHEN 0 THEN 'm' || event_id
          WHEN 1 THEN detail WHEN 2 THEN trim(detail) ELSE 'Reason ' || event_type END
        || ' | HTTP ' || (400 + event_id % 100) || ' Reason ' || event_type
        || CASE event_id % 4 WHEN 0 THEN ' | correlation_id=c' || user_id ELSE '' END
        || ' | https://h.example.com/' || user_id AS line
      FROM (SELECT *, {_DETAIL} AS detail FROM events)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = status.error_message(
        F.expr(_DETAIL),
        F.concat(F.lit("Reason "), "event_type"),
        400 + F.col("event_id") % 100,
        F.concat(F.lit("https://h.example.com/"), F.col("user_id").cast("string")),
    )
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", line.alias("line"))


@query(
    "part_size",
    """SELECT archive_id,
        CASE WHEN requested_mb > 0 THEN greatest(5 * 1048576, requested_mb * 1048576)
          ELSE greatest(67108864, CAST(ceil(CAST(total AS HUGEINT) / 9000) AS BIGINT)) END::BIGINT
          AS part_size_bytes
      FROM (SELECT archive_id, requested_mb, total_bytes * 10000 AS total FROM v_archives)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = sizes.part_size(F.col("total_bytes") * 10000, F.col("requested_mb"))
    return view(spark, sf_dir, "v_archives").select("archive_id", value.alias("part_size_bytes"))


@query(
    "mib_rate",
    """SELECT event_id, round(byte_count / 1048576.0::DOUBLE / greatest(0.001, duration_sec), 2)
        AS rate FROM v_transfer_events""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = sizes.mib_rate(F.col("byte_count"), F.col("duration_sec")).alias("rate")
    return view(spark, sf_dir, "v_transfer_events").select("event_id", value)


@query(
    "compact_import",
    """SELECT entry_no, ordinal, import_id, status,
        CASE WHEN entry_no % 2 = 0 THEN entry_no END AS file_count,
        CASE WHEN entry_no % 3 = 0 THEN 'phase' END AS phase,
        CASE WHEN entry_no % 3 = 0 THEN entry_no END AS items_total
      FROM v_import_listing""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("entry_no").cast("string")
    entry = F.concat(
        F.lit('{"extra":{"deep":[1]},"import_id":"'),
        "import_id",
        F.lit('","status":"'),
        "status",
        F.lit('"'),
        F.when(F.col("entry_no") % 2 == 0, F.concat(F.lit(',"file_count":'), number)).otherwise(""),
        F.when(
            F.col("entry_no") % 3 == 0,
            F.concat(F.lit(',"progress":{"phase":"phase","other":1,"items_total":'), number, F.lit("}")),
        ).otherwise(""),
        F.lit("}"),
    )
    listing = view(spark, sf_dir, "v_import_listing")
    return listing.select("entry_no", "ordinal", F.inline(refs.compact_import(entry))).select(
        "entry_no",
        "ordinal",
        "import_id",
        "status",
        "file_count",
        F.col("progress.phase").alias("phase"),
        F.col("progress.items_total").alias("items_total"),
    )


PARSED_CHECK = r"""
    SELECT dataset_id, path, line, raw,
      CASE WHEN n < 5 THEN 'fields' WHEN NOT numeric THEN 'number'
           WHEN class_value <= -1 THEN 'negative' END AS problem,
      CASE WHEN n >= 5 AND numeric THEN CAST(trunc(class_value) AS BIGINT) END AS class_id,
      CASE WHEN n >= 5 AND numeric THEN class_value END AS class_value, n, numbers
    FROM (
      SELECT *, len(tokens) AS n, numbers[1] AS class_value,
        len(list_filter(tokens, lambda x: NOT regexp_full_match(x,
          '(?i)[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)'
        ))) = 0 AND isfinite(numbers[1]) AS numeric
      FROM (
        SELECT *, list_transform(tokens, lambda x: TRY_CAST(replace(x, '_', '') AS DOUBLE)) AS numbers
        FROM (
          SELECT *, list_filter(string_split_regex(raw, '[ \t]+'), lambda x: x <> '') AS tokens
          FROM v_label_rows)))
    WHERE n > 0"""


@query(
    "parse_label_line",
    f"""SELECT dataset_id, path, line, raw,
        CASE problem WHEN 'negative' THEN 'invalid_yolo_class' WHEN 'fields'
          THEN 'invalid_yolo_label' WHEN 'number' THEN 'invalid_yolo_label' END AS code,
        CASE problem WHEN 'negative' THEN 'YOLO class id must be non-negative'
          WHEN 'fields' THEN 'YOLO label rows must contain class plus coordinates'
          WHEN 'number' THEN 'YOLO label rows must be numeric' END AS message,
        class_id, CASE WHEN class_id IS NOT NULL THEN n - 1 END AS n_coords,
        CASE WHEN class_id IS NOT NULL THEN numbers[4] END AS third_coord
      FROM ({PARSED_CHECK})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_label_rows").withColumn("raw_text", F.col("raw"))
    return parse_labels(rows).select(
        "dataset_id",
        "path",
        "line",
        F.col("raw_text").alias("raw"),
        "code",
        "message",
        "class_id",
        F.when(F.col("coords").isNotNull(), F.size("coords")).cast("bigint").alias("n_coords"),
        F.try_element_at("coords", F.lit(3)).alias("third_coord"),
    )


@query(
    "fill_missing",
    """SELECT dataset_id, relative_path, coalesce(nullif(sha256, ''), 'other') AS sha256,
        coalesce(nullif(width, 0), nullif(height, 0)) AS width
      FROM v_state_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_state_files").select(
        "dataset_id",
        "relative_path",
        sizes.fill_missing_text(F.col("sha256"), F.lit("other")).alias("sha256"),
        sizes.fill_missing_number(F.col("width"), F.col("height")).alias("width"),
    )


@query(
    "promote_refs",
    """SELECT result_id, coalesce(own_ref, complete_ref, multipart_ref, job_ref) AS manifest_id,
        coalesce(multipart_ref, job_ref) AS lease_id
      FROM v_results""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, lease = "dataset_manifest_ref", "read_lease"

    def ref(name: str) -> Column:
        """The reference as an object, or a plain string that must be passed over."""
        return F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("id")))

    document = F.to_json(
        F.struct(
            ref("own_ref").alias(key),
            F.struct(ref("complete_ref").alias(key), F.lit("text").alias(lease)).alias("complete"),
            F.struct(
                F.struct(ref("multipart_ref").alias(key), ref("multipart_ref").alias(lease)).alias(
                    "complete"
                )
            ).alias("multipart"),
            F.struct(ref("job_ref").alias(key), ref("job_ref").alias(lease)).alias("job"),
        )
    )
    promoted = view(spark, sf_dir, "v_results").withColumn("r", refs.promote_refs(document))
    return promoted.select(
        "result_id",
        F.get_json_object(f"r.{key}", "$.id").alias("manifest_id"),
        F.get_json_object(f"r.{lease}", "$.id").alias("lease_id"),
    )


@query("content_sha256", "SELECT page_id, sha256(html) AS sha256 FROM pages")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    digest = refs.content_sha256(F.col("html").cast("binary")).alias("sha256")
    return pages.select("page_id", digest)


@query(
    "label_number_spelling",
    r"""SELECT dataset_id, path, line, raw, len(list_filter(tokens, lambda x: regexp_full_match(x,
        '(?i)[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?|nan)'
      )))::INT AS n_numbers
      FROM (SELECT *, string_split_regex(raw, '[ \t]+') AS tokens FROM v_label_rows)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = labels.label_numbers(labels.label_tokens(F.col("raw")))
    count = F.size(F.filter(numbers, lambda n: n.isNotNull())).alias("n_numbers")
    return view(spark, sf_dir, "v_label_rows").select("dataset_id", "path", "line", "raw", count)
