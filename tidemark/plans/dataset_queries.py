"""Queries over manifests: integrity, roll-ups, order, sampling and planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import split_lines
from tidemark.functions.paths import component_order, is_dataset_image, string_order
from tidemark.operators import classes as catalog
from tidemark.operators import ordering, planning, summary, verify
from tidemark.plans.registry import query
from tidemark.plans.scalar_queries import PARSED_CHECK
from tidemark.plans.views import STATE_DIR, table, view
from tidemark.sources import documents

# DuckDB pieces shared by the checks.
_IMAGE = r"regexp_matches(relative_path, '(?i)[^/]\.(jpe?g|png|bmp|webp)$')"
_DATASET_IMAGE = f"(relative_path LIKE 'images/%' AND {_IMAGE})"
_LABEL = "(relative_path LIKE 'labels/%.txt')"
_CLASS_FILE = (
    "relative_path IN ('data.yaml', 'data.yml', 'dataset.yaml', 'dataset.yml', 'classes.txt')"
)
_EXPECTED = r"'labels/' || substr(regexp_replace(relative_path, '\.[^./]+$', ''), 8) || '.txt'"
_COMPONENTS = "string_split(relative_path, '/')"
_YOLO = "(SELECT dataset_id FROM v_datasets WHERE lower(format) = 'yolo')"

_NO_IMAGES_CHECK = f"""
    SELECT dataset_id, 'error' AS severity, 'no_images' AS code, CAST(NULL AS VARCHAR) AS path,
      CAST(NULL AS BIGINT) AS line, CAST(NULL AS BIGINT) AS class_id,
      CAST(NULL AS VARCHAR) AS expected_label_path,
      CASE WHEN lower(format) = 'yolo' THEN 'YOLO dataset has no images/'
        ELSE 'dataset has no image files' END AS message
    FROM v_datasets d WHERE NOT EXISTS (
      SELECT 1 FROM v_files f WHERE f.dataset_id = d.dataset_id
        AND CASE WHEN lower(d.format) = 'yolo' THEN {_DATASET_IMAGE} ELSE {_IMAGE} END)"""
_MISSING_NAMES_CHECK = f"""
    SELECT dataset_id, 'warning' AS severity, 'missing_class_names' AS code,
      CAST(NULL AS VARCHAR) AS path, CAST(NULL AS BIGINT) AS line, CAST(NULL AS BIGINT) AS class_id,
      CAST(NULL AS VARCHAR) AS expected_label_path,
      'YOLO dataset has no classes.txt or data.yaml class names' AS message
    FROM v_datasets WHERE lower(format) = 'yolo'
      AND dataset_id NOT IN (SELECT dataset_id FROM v_classes)
      AND dataset_id NOT IN (SELECT dataset_id FROM v_files WHERE {_CLASS_FILE})"""


def _missing_labels_check(files: str = "v_files") -> str:
    return f"""
    SELECT dataset_id, 'warning' AS severity, 'missing_yolo_label' AS code, relative_path AS path,
      CAST(NULL AS BIGINT) AS line, CAST(NULL AS BIGINT) AS class_id,
      {_EXPECTED} AS expected_label_path, 'image has no matching YOLO label file' AS message
    FROM {files} WHERE {_DATASET_IMAGE} AND (dataset_id, {_EXPECTED}) NOT IN
      (SELECT (dataset_id, relative_path) FROM v_files)"""


def _orphan_labels_check(files: str = "v_files") -> str:
    return f"""
    SELECT dataset_id, 'warning' AS severity, 'orphan_yolo_label' AS code, relative_path AS path,
      CAST(NULL AS BIGINT) AS line, CAST(NULL AS BIGINT) AS class_id,
      CAST(NULL AS VARCHAR) AS expected_label_path, 'label has no matching image file' AS message
    FROM {files} WHERE {_LABEL} AND (dataset_id, relative_path) NOT IN
      (SELECT (dataset_id, {_EXPECTED}) FROM v_files WHERE {_DATASET_IMAGE})"""


_LINE_ERRORS_CHECK = f"""
    SELECT dataset_id, 'error' AS severity,
      CASE problem WHEN 'negative' THEN 'invalid_yolo_class' ELSE 'invalid_yolo_label' END AS code,
      path, line, CAST(NULL AS BIGINT) AS class_id, CAST(NULL AS VARCHAR) AS expected_label_path,
      CASE problem WHEN 'negative' THEN 'YOLO class id must be non-negative'
        WHEN 'fields' THEN 'YOLO label rows must contain class plus coordinates'
        ELSE 'YOLO label rows must be numeric' END AS message
    FROM ({PARSED_CHECK}) WHERE problem IS NOT NULL"""
_RANGE_CHECK = f"""
    SELECT p.dataset_id, 'warning' AS severity, 'unknown_yolo_class' AS code, path, line, class_id,
      CAST(NULL AS VARCHAR) AS expected_label_path,
      'YOLO class id is outside declared class names' AS message
    FROM ({PARSED_CHECK}) p
    JOIN (SELECT dataset_id, count(*) AS n FROM v_classes GROUP BY 1) c USING (dataset_id)
    WHERE problem IS NULL AND class_id >= c.n"""
_YOLO_FILES = f"(SELECT * FROM v_files WHERE dataset_id IN {_YOLO})"
FINDINGS_CHECK = f"""
    {_NO_IMAGES_CHECK} UNION ALL {_MISSING_NAMES_CHECK}
    UNION ALL {_missing_labels_check(_YOLO_FILES)} UNION ALL {_orphan_labels_check(_YOLO_FILES)}
    UNION ALL SELECT * FROM ({_LINE_ERRORS_CHECK}) WHERE dataset_id IN {_YOLO}
    UNION ALL SELECT * FROM ({_RANGE_CHECK}) WHERE dataset_id IN {_YOLO}"""
SUMMARY_CHECK = f"""
    SELECT d.dataset_id, d.source, lower(d.format) AS format, count(f.relative_path) AS file_count,
      CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_bytes,
      count(*) FILTER ({_IMAGE}) AS image_count, count(*) FILTER ({_LABEL}) AS label_count,
      coalesce((SELECT string_agg(class_name, '|' ORDER BY class_id) FROM v_classes c
        WHERE c.dataset_id = d.dataset_id), '') AS class_list,
      coalesce(array_to_string(list(relative_path ORDER BY {_COMPONENTS})[1:10], '|'), '')
        AS first_files
    FROM v_datasets d LEFT JOIN v_files f ON f.dataset_id = d.dataset_id GROUP BY ALL"""


def _inputs(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, f"v_{n}") for n in names]


def _flat(found: DataFrame) -> DataFrame:
    return found.select(*verify.FINDING_COLUMNS)


@query("missing_labels", _missing_labels_check())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.missing_labels(*_inputs(spark, sf_dir, "files"))


@query("orphan_labels", _orphan_labels_check())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.orphan_labels(*_inputs(spark, sf_dir, "files"))


@query("label_pairing", f"{_missing_labels_check()} UNION ALL {_orphan_labels_check()}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.label_pairing(*_inputs(spark, sf_dir, "files"))


@query("no_images", _NO_IMAGES_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.no_images(*_inputs(spark, sf_dir, "datasets", "files"))


@query("missing_class_names", _MISSING_NAMES_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.missing_class_names(*_inputs(spark, sf_dir, "datasets", "files", "classes"))


@query("has_class_file", f"SELECT DISTINCT dataset_id FROM v_files WHERE {_CLASS_FILE}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.has_class_file(*_inputs(spark, sf_dir, "files"))


@query("check_class_range", _RANGE_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, classes = _inputs(spark, sf_dir, "label_rows", "classes")
    return verify.check_class_range(verify.annotations(lines), summary.class_counts(classes))


@query("invalid_label_lines", _LINE_ERRORS_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.invalid_label_lines(*_inputs(spark, sf_dir, "label_rows"))


@query(
    "annotations",
    f"""SELECT dataset_id, path, line, class_id, n - 1 AS n_coords,
        list_sum(list_filter(numbers[2:], lambda x: isfinite(x))) AS coord_sum
      FROM ({PARSED_CHECK}) WHERE class_id >= 0 AND problem IS NULL""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = verify.annotations(*_inputs(spark, sf_dir, "label_rows"))
    finite = F.filter("coords", lambda x: F.abs(x) < float("inf"))
    return marked.select(
        "dataset_id",
        "path",
        "line",
        "class_id",
        F.size("coords").cast("bigint").alias("n_coords"),
        F.aggregate(finite, F.lit(0.0), lambda a, x: a + x).alias("coord_sum"),
    )


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.dataset_findings(
        *_inputs(spark, sf_dir, "datasets", "files", "classes", "label_rows")
    )


@query("findings", FINDINGS_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_findings(spark, sf_dir))


@query(
    "findings_by_code",
    f"""SELECT dataset_id, severity, code, count(*) AS findings FROM ({FINDINGS_CHECK})
      GROUP BY ALL""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _findings(spark, sf_dir)
    return found.groupBy("dataset_id", "severity", "code").agg(
        F.count(F.lit(1)).alias("findings")
    )


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.dataset_summary(*_inputs(spark, sf_dir, "datasets", "files", "classes"))


def _joined_lists(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("class_list", F.array_join("classes", "|"))
        .withColumn("first_files", F.array_join("sample_files", "|"))
        .drop("classes", "sample_files")
    )


@query("dataset_summary", SUMMARY_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_lists(_summary(spark, sf_dir))


@query(
    "verify_dataset",
    f"""SELECT s.*, CASE WHEN coalesce(error_count, 0) > 0 THEN 'failed' ELSE 'ok' END AS status,
        coalesce(error_count, 0) AS error_count, coalesce(warning_count, 0) AS warning_count
      FROM ({SUMMARY_CHECK}) s LEFT JOIN (
        SELECT dataset_id, count(*) FILTER (severity = 'error') AS error_count,
          count(*) FILTER (severity = 'warning') AS warning_count
        FROM ({FINDINGS_CHECK}) GROUP BY 1) c USING (dataset_id)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_lists(
        verify.verify_dataset(_summary(spark, sf_dir), _findings(spark, sf_dir))
    )


@query(
    "session_record",
    f"""SELECT dataset_id, format, regexp_extract(source, '[^/]*$') AS root_name,
        'task_' || length(dataset_id) AS task_key,
        CASE WHEN length(dataset_id) % 2 = 0 THEN 'given' ELSE class_list END AS class_list,
        file_count, total_bytes, length(dataset_id) % 3 <> 0 AS auto_crop_embedding
      FROM ({SUMMARY_CHECK})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.length("dataset_id")
    overrides = view(spark, sf_dir, "v_datasets").select(
        "dataset_id",
        F.concat(F.lit("task_"), size.cast("string")).alias("task_key"),
        F.when(size % 2 == 0, F.array(F.lit("given"))).alias("explicit_classes"),
        (size % 3 != 0).alias("auto_crop_embedding"),
    )
    record = summary.session_record(_summary(spark, sf_dir), overrides)
    return record.withColumn("class_list", F.array_join("classes", "|")).drop("classes")


@query(
    "archive_summary",
    f"""SELECT dataset_id, count(*) AS file_count, CAST(sum(size_bytes) AS BIGINT) AS payload_bytes
      FROM v_files WHERE NOT list_contains({_COMPONENTS}, '{STATE_DIR}') GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.archive_summary(*_inputs(spark, sf_dir, "files"), STATE_DIR)


@query(
    "component_order",
    f"""SELECT dataset_id, relative_path,
        row_number() OVER (PARTITION BY dataset_id ORDER BY {_COMPONENTS}) - 1 AS position
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path")
    order = [component_order(F.col("relative_path"))]
    return ordering.number_rows(files, ["dataset_id"], order, "position")


@query(
    "string_order",
    """SELECT dataset_id, relative_path,
        row_number() OVER (PARTITION BY dataset_id ORDER BY relative_path) - 1 AS position
      FROM v_files""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path")
    order = [string_order(F.col("relative_path"))]
    return ordering.number_rows(files, ["dataset_id"], order, "position")


@query(
    "sample_files",
    f"""SELECT dataset_id, array_to_string(list(relative_path ORDER BY {_COMPONENTS})[1:10], '|')
        AS first_files FROM v_files GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = summary.sample_files(*_inputs(spark, sf_dir, "files"))
    return few.select("dataset_id", F.array_join("sample_files", "|").alias("first_files"))


@query(
    "sample_missing",
    f"""SELECT dataset_id, array_to_string(list(relative_path ORDER BY {_COMPONENTS})[1:5], '|')
        AS first_missing
      FROM v_files WHERE (dataset_id, relative_path) NOT IN
        (SELECT (dataset_id, relative_path) FROM v_state_files) GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, state = _inputs(spark, sf_dir, "files", "state_files")
    few = summary.sample_missing(files.join(state, list(planning.KEYS), "left_anti"))
    return few.select("dataset_id", F.array_join("sample_missing", "|").alias("first_missing"))


def _limit_check(n: int) -> str:
    return f"""SELECT dataset_id, relative_path FROM v_files QUALIFY row_number()
        OVER (PARTITION BY dataset_id ORDER BY {_COMPONENTS}) <= {n}"""


@query("limit_files", _limit_check(100))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = summary.limit_files(*_inputs(spark, sf_dir, "files"), 100)
    return kept.select("dataset_id", "relative_path")


@query("limit_files_large", _limit_check(2000))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path")
    return summary.limit_files(files, 2000)


def _sample_check(n: int) -> str:
    return f"""
    WITH picked AS (SELECT * FROM v_files WHERE {_DATASET_IMAGE}
      QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY relative_path) <= {n})
    SELECT dataset_id, relative_path, 'image' AS part FROM picked
    UNION SELECT dataset_id, relative_path, 'label' FROM v_files WHERE (dataset_id, relative_path)
      IN (SELECT (dataset_id, {_EXPECTED}) FROM picked)
    UNION SELECT dataset_id, relative_path, 'metadata' FROM v_files WHERE {_CLASS_FILE}
      OR (relative_path LIKE '%.json' AND strpos(relative_path, '/') = 0)"""


@query("sample_selection", _sample_check(40))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = summary.sample_selection(*_inputs(spark, sf_dir, "files"), 40)
    return picked.select("dataset_id", "relative_path", "part")


@query(
    "limit_samples",
    f"""SELECT dataset_id, relative_path, size_bytes FROM v_files WHERE (dataset_id, relative_path)
      IN (SELECT (dataset_id, relative_path) FROM ({_sample_check(25)}))""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = summary.limit_samples(*_inputs(spark, sf_dir, "files"), 25)
    return kept.select("dataset_id", "relative_path", "size_bytes")


@query(
    "sample_labels",
    f"""SELECT dataset_id, relative_path FROM v_files WHERE (dataset_id, relative_path) IN
        (SELECT (dataset_id, {_EXPECTED}) FROM v_files WHERE {_DATASET_IMAGE})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    (files,) = _inputs(spark, sf_dir, "files")
    images = files.where(is_dataset_image(F.col("relative_path")))
    return summary.sample_labels(files, images).select("dataset_id", "relative_path")


@query(
    "compact_class_ids",
    "SELECT dataset_id, class_id, class_name FROM v_classes",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.compact_class_ids(*_inputs(spark, sf_dir, "class_names"))


_SEPARATORS = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"


@query(
    "read_label_lines",
    f"""SELECT dataset_id, path, line, raw FROM (
        SELECT source AS dataset_id, CAST(doc_id AS VARCHAR) AS path,
          unnest(string_split_regex(text, '{_SEPARATORS}')) AS raw,
          CAST(generate_subscripts(string_split_regex(text, '{_SEPARATORS}'), 1) AS BIGINT) AS line
        FROM documents) WHERE NOT regexp_full_match(raw, '[\\s\\x{{a0}}]*')""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset_id"), F.col("doc_id").cast("string").alias("path"), "text"
    )
    return documents.read_label_lines(texts)


@query(
    "line_counts",
    f"""SELECT page_id, len(string_split_regex(html, '{_SEPARATORS}'))::INT AS n_lines FROM pages""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.size(split_lines(F.col("html"))).alias("n_lines"))


@query(
    "select_class_metadata",
    f"""SELECT dataset_id, arg_min(relative_path, list_position(
          ['data.yaml', 'data.yml', 'dataset.yaml', 'dataset.yml', 'classes.txt'], relative_path))
        AS relative_path
      FROM v_files WHERE {_CLASS_FILE} GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.select_class_metadata(*_inputs(spark, sf_dir, "files"))


def _batched(spark: SparkSession, sf_dir: str, size: int = 64) -> DataFrame:
    files = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path", "size_bytes")
    return planning.assign_batches(files, size)


_BATCH_CHECK = f"""SELECT dataset_id, relative_path, size_bytes,
    CAST(floor((row_number() OVER (PARTITION BY dataset_id ORDER BY {_COMPONENTS}) - 1) / 64)
      AS BIGINT) AS batch_id FROM v_files"""


@query("assign_batches", _BATCH_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).drop("row_index")


@query(
    "batch_totals",
    f"""SELECT dataset_id, batch_id, count(*) AS file_count,
        CAST(sum(size_bytes) AS BIGINT) AS byte_count FROM ({_BATCH_CHECK}) GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planning.batch_totals(_batched(spark, sf_dir))


@query(
    "batch_manifests",
    f"""SELECT dataset_id, batch_id, '{{"files":[' || string_agg('{{"relative_path":"' ||
          relative_path || '","size_bytes":' || size_bytes || '}}', ',' ORDER BY {_COMPONENTS})
        || ']}}' AS body FROM ({_BATCH_CHECK}) GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path", "size_bytes")
    return planning.batch_manifests(files, 64)


_SPLIT_CHECK = """SELECT f.dataset_id, f.relative_path, CASE WHEN NOT coalesce(uploaded, false)
    THEN 'pending_upload' WHEN NOT coalesce(streamed, false) THEN 'pending_stream' ELSE 'done' END
    AS status
  FROM v_files f LEFT JOIN v_state_files s
    ON f.dataset_id = s.dataset_id AND f.relative_path = s.relative_path"""


@query("resume_split", _SPLIT_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, state = _inputs(spark, sf_dir, "files", "state_files")
    return planning.resume_split(files.select("dataset_id", "relative_path"), state)


@query(
    "enrich_from_state",
    """SELECT f.dataset_id, f.relative_path,
        coalesce(CASE WHEN file_no % 6 = 0 THEN 'own' END, nullif(s.sha256, '')) AS sha256,
        coalesce(nullif(CASE WHEN file_no % 7 = 0 THEN 0 ELSE f.size_bytes END, 0), s.size_bytes)
          AS size_bytes,
        nullif(s.width, 0) AS width, nullif(s.height, 0) AS height,
        CASE file_no % 8 WHEN 1 THEN 'image/jpeg' WHEN 3 THEN 'image/png' WHEN 5 THEN 'text/plain'
          WHEN 7 THEN 'x/misc' ELSE 'x/own' END AS content_type
      FROM v_files f LEFT JOIN v_state_files s
        ON f.dataset_id = s.dataset_id AND f.relative_path = s.relative_path""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, state = _inputs(spark, sf_dir, "files", "state_files")
    number = F.col("file_no")
    manifest = files.select(
        "dataset_id",
        "relative_path",
        F.when(number % 6 == 0, "own").alias("sha256"),
        F.when(number % 7 == 0, 0).otherwise(F.col("size_bytes")).alias("size_bytes"),
        F.lit(None).cast("int").alias("width"),
        F.lit(0).alias("height"),
        F.when(number % 8 == 7, "x/misc").when(number % 2 == 0, "x/own").alias("content_type"),
    )
    return planning.enrich_from_state(manifest, state)


_MATCH_CHECK = """SELECT f.dataset_id, f.relative_path,
    nullif(trim(coalesce(nullif(upload_url, ''), url)), '') AS signed_url
  FROM v_files f LEFT JOIN (SELECT * FROM v_responses QUALIFY row_number() OVER
    (PARTITION BY dataset_id, relative_path ORDER BY ordinal DESC) = 1) r
    ON f.dataset_id = r.dataset_id AND f.relative_path = r.relative_path"""


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, responses = _inputs(spark, sf_dir, "files", "responses")
    return planning.match_signed_urls(files.select("dataset_id", "relative_path"), responses)


@query("match_signed_urls", _MATCH_CHECK)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir)


@query(
    "unsigned_files",
    f"""SELECT dataset_id, count(*) AS missing_count,
        array_to_string(list(relative_path ORDER BY {_COMPONENTS})[1:5], '|') AS first_missing
      FROM ({_MATCH_CHECK}) WHERE signed_url IS NULL GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = planning.unsigned_files(_matched(spark, sf_dir))
    joined = few.withColumn("first_missing", F.array_join("sample_missing", "|"))
    return joined.drop("sample_missing")


@query(
    "last_wins",
    """SELECT dataset_id, relative_path, ordinal, upload_url, url FROM v_responses
      QUALIFY row_number() OVER (PARTITION BY dataset_id, relative_path ORDER BY ordinal DESC) = 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.last_wins(
        view(spark, sf_dir, "v_responses"), ["dataset_id", "relative_path"], "ordinal"
    )


@query(
    "ordered_distinct",
    """SELECT dataset_id, url, min(file_no) AS file_no FROM (
        SELECT dataset_id, file_no, CASE WHEN file_no % 9 = 0 THEN ''
          ELSE string_split(relative_path, '/')[1] END AS url FROM v_files)
      WHERE url <> '' GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    (files,) = _inputs(spark, sf_dir, "files")
    top = F.when(F.col("file_no") % 9 == 0, "").otherwise(
        F.substring_index("relative_path", "/", 1)
    )
    named = files.select("dataset_id", "file_no", top.alias("url"))
    return ordering.ordered_distinct(named, ["dataset_id"], "url", "file_no")


@query(
    "upload_completeness",
    f"""SELECT dataset_id, count(*) AS expected,
        count(*) FILTER (status = 'pending_upload') AS uploaded_missing,
        count(*) FILTER (status = 'pending_stream') AS streamed_missing,
        coalesce(array_to_string((list(relative_path ORDER BY {_COMPONENTS})
          FILTER (status = 'pending_upload'))[1:5], '|'), '') AS first_uploaded,
        coalesce(array_to_string((list(relative_path ORDER BY {_COMPONENTS})
          FILTER (status = 'pending_stream'))[1:5], '|'), '') AS first_streamed
      FROM ({_SPLIT_CHECK}) GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = planning.upload_completeness(*_inputs(spark, sf_dir, "files", "state_files"))

    def joined(name: str) -> Column:
        return F.coalesce(F.array_join(name, "|"), F.lit(""))

    return audit.select(
        "dataset_id",
        "expected",
        "uploaded_missing",
        "streamed_missing",
        joined("sample_uploaded_missing").alias("first_uploaded"),
        joined("sample_streamed_missing").alias("first_streamed"),
    )
