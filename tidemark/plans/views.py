"""Views that give the driver tables the shape of manifests, labels, imports and transfers.

The SQL is common to Spark and DuckDB, so one text builds the input of a query and of its check.
Every view reads its whole tables. A third of the groups belong to dataset ``ds_0`` (and likewise
project ``proj_0`` and run 0), so hot keys are always present.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

STATE_DIR = ".transfer-state"

VIEWS = {
    "v_slots": """
        SELECT o_orderkey AS file_no, CAST(floor(o_totalprice * 100) AS BIGINT) AS size_bytes,
          o_orderkey % 8 AS k, g, CAST(floor(g / 40) AS BIGINT) AS block,
          CASE WHEN g % 3 = 0 THEN 0 ELSE CAST(floor(g / 40) AS BIGINT) END AS d,
          CASE WHEN g % 10 < 8 THEN 'train' ELSE 'val' END AS sp
        FROM (SELECT o_orderkey, o_totalprice, CAST(floor(o_orderkey / 8) AS BIGINT) AS g
              FROM {orders}) t""",
    "v_files": f"""
        SELECT 'ds_' || CAST(d AS STRING) AS dataset_id, file_no, size_bytes,
          CASE
            WHEN k IN (0, 1, 2) THEN 'images/' || sp || '/' || CAST(file_no AS STRING) || '.jpg'
            WHEN k = 3 THEN 'images/' || sp || '/' || CAST(file_no AS STRING) || '.v2.PNG'
            WHEN k IN (4, 5) THEN 'labels/' || sp || '/' || CAST(file_no - 4 AS STRING) || '.txt'
            WHEN k = 6 THEN 'labels/' || sp || '/orphan-' || CAST(file_no AS STRING) || '.txt'
            WHEN g % 40 = 1 AND g % 3 <> 0 AND block % 4 = 0 THEN 'classes.txt'
            WHEN g % 40 = 1 AND g % 3 <> 0 AND block % 4 = 1 THEN 'data.yaml'
            WHEN g % 40 = 1 AND g % 3 <> 0 AND block % 4 = 2 THEN 'dataset.yml'
            WHEN g % 40 = 1 AND g % 3 <> 0 THEN 'data.yml'
            WHEN g % 40 = 2 AND g % 3 <> 0 AND block % 2 = 0 THEN 'dataset.yaml'
            WHEN g % 5 = 0 THEN 'meta_' || CAST(g AS STRING) || '.json'
            WHEN g % 5 = 1 THEN '{STATE_DIR}/imports/' || CAST(g AS STRING) || '.json'
            WHEN g % 5 = 2 THEN 'images-extra/' || CAST(g AS STRING) || '.webp'
            WHEN g % 5 = 3 THEN 'images/' || sp || '/d' || CAST(g AS STRING) || '/.png'
            ELSE 'notes/' || CAST(g AS STRING) || '.tar.gz' END AS relative_path
        FROM v_slots""",
    "v_datasets": """
        SELECT 'ds_' || CAST(d AS STRING) AS dataset_id,
          '/data/sets/ds_' || CAST(d AS STRING) AS source,
          CASE d % 10 WHEN 3 THEN 'coco' WHEN 4 THEN 'ImageNet' ELSE 'yolo' END AS format
        FROM (SELECT DISTINCT d FROM v_slots) t
        UNION ALL
        SELECT 'ds_empty_' || CAST(s_suppkey AS STRING),
          '/data/sets/empty/' || CAST(s_suppkey AS STRING),
          CASE s_suppkey % 3 WHEN 0 THEN 'coco' ELSE 'yolo' END
        FROM {supplier}""",
    "v_class_names": """
        SELECT CASE WHEN CAST(floor(p_partkey / 40) AS BIGINT) % 6 = 5 THEN 'zz_' ELSE 'ds_' END
            || CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS dataset_id,
          CAST(p_partkey % 40 * 3 AS BIGINT) AS name_key,
          CASE WHEN p_partkey % 7 = 0 THEN '  ' ELSE ' ' || p_name || ' ' END AS raw_name
        FROM {part}""",
    "v_classes": """
        SELECT dataset_id,
          CAST(row_number() OVER (PARTITION BY dataset_id ORDER BY name_key, raw_name) - 1 AS INT)
            AS class_id,
          trim(raw_name) AS class_name
        FROM v_class_names WHERE trim(raw_name) <> ''""",
    "v_label_rows": """
        SELECT 'ds_' || CAST(CASE WHEN g % 3 = 0 THEN 0 ELSE CAST(floor(g / 40) AS BIGINT) END
            AS STRING) AS dataset_id,
          'labels/' || CASE WHEN g % 10 < 8 THEN 'train' ELSE 'val' END || '/' ||
            CASE WHEN k < 3 THEN CAST(g * 8 AS STRING)
                 WHEN k < 6 THEN CAST(g * 8 + 1 AS STRING)
                 ELSE 'orphan-' || CAST(g * 8 + 6 AS STRING) END || '.txt' AS path,
          CAST(l_linenumber + 10 * k AS BIGINT) AS line,
          CASE WHEN l_partkey % 11 = 0 THEN c || ' 0.5 0.5'
               WHEN l_partkey % 13 = 0 THEN c || ' 0.5 x 0.2 0.2'
               WHEN l_partkey % 17 = 0 THEN '   '
               WHEN l_partkey % 19 = 0 THEN '1.0d 0.5 0.5 0.2 0.2'
               WHEN l_partkey % 23 = 0 THEN '1_0 0.5 0.5 0.2 .2e-1'
               WHEN l_partkey % 29 = 0 THEN '-0.5 0.5 0.5 0.2 0.2'
               WHEN l_partkey % 31 = 0 THEN c || ' 1 0 0 1 1. 1 0.25 Infinity'
               WHEN l_partkey % 37 = 0 THEN 'NaN 0.5 0.5 0.2 0.2'
               ELSE chr(9) || c || '.0 ' || CAST(CAST(l_discount AS DECIMAL(4,2)) AS STRING)
                 || '  ' || CAST(CAST(l_tax AS DECIMAL(4,2)) AS STRING) || ' 0.25 0.25 ' END AS raw
        FROM (SELECT l_partkey, l_linenumber, l_discount, l_tax, l_orderkey % 8 AS k,
                CAST(floor(l_orderkey / 8) AS BIGINT) AS g, CAST(l_suppkey - 1 AS STRING) AS c
              FROM {lineitem}) t""",
    "v_state_files": """
        SELECT dataset_id,
          CASE WHEN file_no % 5 = 0 THEN 'removed/' || relative_path ELSE relative_path END
            AS relative_path,
          file_no % 3 <> 0 AS uploaded, file_no % 3 = 1 AS streamed,
          CASE WHEN file_no % 2 = 0 THEN '' ELSE 'h' || CAST(file_no AS STRING) END AS sha256,
          size_bytes, CAST(file_no % 640 AS INT) AS width, CAST(file_no % 480 AS INT) AS height
        FROM v_files""",
    "v_responses": """
        SELECT dataset_id,
          CASE WHEN file_no % 4 = 0 THEN 'other/' || relative_path ELSE relative_path END
            AS relative_path,
          ordinal,
          CASE WHEN (file_no + ordinal) % 3 = 0 THEN ''
               ELSE 'https://s.example.com/' || CAST(file_no * 10 + ordinal AS STRING) END
            AS upload_url,
          CASE WHEN file_no % 7 = 0 THEN ' ' ELSE '/u/' || CAST(file_no AS STRING) END AS url
        FROM (SELECT *, 1 AS ordinal FROM v_files UNION ALL SELECT *, 2 FROM v_files) r""",
    "v_import_listing": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'proj_0'
                    ELSE 'proj_' || CAST(o_custkey % 10 AS STRING) END AS project_id,
          CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'imp_' || CAST(o_orderkey AS STRING) END
            AS import_id,
          CASE o_orderstatus WHEN 'F' THEN 'Succeeded' WHEN 'O' THEN ' running'
            ELSE CASE o_orderkey % 4 WHEN 0 THEN 'ready' WHEN 1 THEN 'FAILED'
              WHEN 2 THEN ' canceled ' ELSE 'queued' END END AS status,
          o_orderkey AS entry_no, CAST(2 AS INT) AS ordinal
        FROM {orders}
        UNION ALL
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'proj_0'
                    ELSE 'proj_' || CAST(o_custkey % 10 AS STRING) END,
          'imp_' || CAST(o_orderkey AS STRING),
          CASE WHEN o_orderkey % 2 = 0 THEN 'completed' ELSE 'queued' END,
          o_orderkey, CAST(1 AS INT)
        FROM {orders}""",
    "v_import_state": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'proj_0'
                    ELSE 'proj_' || CAST(o_custkey % 10 AS STRING) END AS project_id,
          CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 7 = 0
                 THEN 'local_' || CAST(o_orderkey AS STRING)
               ELSE 'imp_' || CAST(o_orderkey AS STRING) END AS import_id,
          '/data/sets/ds_' || CAST(o_custkey % 100 AS STRING) AS source,
          CASE o_orderkey % 5 WHEN 0 THEN 'coco' ELSE 'yolo' END AS format,
          o_orderstatus <> 'O' AND o_orderkey % 5 <> 1 AS completed,
          '/state/' || CAST(o_orderkey AS STRING) || '.json' AS state_path,
          CAST(o_orderdate AS TIMESTAMP) AS mtime
        FROM {orders}""",
    "v_import_files": """
        SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'proj_0' ELSE 'proj_1' END AS project_id,
          CASE WHEN l_orderkey % 3 = 0 THEN 'imp_hot' ELSE 'imp_' || CAST(l_orderkey AS STRING) END
            AS import_id,
          'images/' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-'
            || CAST(l_linenumber AS STRING) || '.jpg' AS relative_path,
          CAST(l_quantity AS BIGINT) * 1024 AS size_bytes,
          CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_returnflag <> 'N' END AS uploaded,
          CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE l_returnflag = 'A' AND l_linestatus = 'F' END
            AS streamed
        FROM {lineitem}""",
    "v_transfer_events": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type AS name,
          CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS run_id,
          CAST(floor(event_id / 700) AS BIGINT) AS batch_id,
          CASE WHEN event_id % 97 = 0 THEN -value ELSE value END AS duration_sec,
          CASE event_type WHEN 'error' THEN
            CASE event_id % 5 WHEN 0 THEN 503 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 401
              ELSE 500 END ELSE 200 END AS http_status,
          CAST(event_id % 4 AS INT) + 1 AS attempt,
          CASE event_type WHEN 'signup' THEN 0 ELSE CAST(event_id % 64 AS BIGINT) - 2 END
            AS file_count,
          CASE event_type WHEN 'signup' THEN 0 ELSE CAST(event_id % 64 AS BIGINT) * 4096 END
            AS byte_count
        FROM {events}""",
    "v_archives": """
        SELECT o_orderkey AS archive_id,
          CASE WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 0 THEN 0
               ELSE CAST(floor(o_totalprice * 1000) AS BIGINT) END AS total_bytes,
          CAST(CAST(floor(o_orderkey / 100) AS BIGINT) % 4 * 16 AS INT) AS requested_mb
        FROM {orders}""",
    "v_results": """
        SELECT o_orderkey AS result_id,
          CASE WHEN o_orderkey % 11 = 0 THEN 'own_' || CAST(o_orderkey AS STRING) END AS own_ref,
          CASE WHEN o_orderkey % 3 = 0 THEN 'dm_' || CAST(o_orderkey AS STRING) END AS complete_ref,
          CASE WHEN o_orderkey % 5 = 0 THEN 'ar_' || CAST(o_orderkey AS STRING) END
            AS multipart_ref,
          CASE WHEN o_orderkey % 7 = 0 THEN 'job_' || CAST(o_orderkey AS STRING) END AS job_ref
        FROM {orders}""",
    "v_urls": """
        SELECT page_id, url,
          CASE page_id % 4 WHEN 0 THEN '  ' || url || ' '
            WHEN 1 THEN '/files/' || CAST(page_id AS STRING) || '?sig=a%2Fb'
            WHEN 2 THEN 'relative/' || CAST(page_id AS STRING) ELSE upper(url) END AS raw_url,
          CASE page_id % 3 WHEN 0 THEN 'HTTPS://user:pw@Api.example.com:8443/v1?x#y'
            WHEN 1 THEN 'http://api.example.com' ELSE 'api.example.com/v1' END AS base,
          CASE page_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' http://127.0.0.1:9000// '
            WHEN 2 THEN 'https://Mirror.example.org/ignored?q' WHEN 3 THEN 'ftp://x'
            ELSE 'http://10.0.0.1' END AS origin
        FROM {pages}""",
    "v_polls": """
        SELECT CASE WHEN user_id % 3 = 0 THEN 'proj_0' ELSE 'proj_1' END AS project_id,
          'imp_' || CAST(user_id * 10 + event_id % 10 AS STRING) AS import_id,
          CAST(ts AS TIMESTAMP) AS ts,
          CASE WHEN event_id % 40 > 1 THEN 'running' WHEN event_type = 'error' THEN 'Failed'
            WHEN event_type = 'purchase' THEN ' succeeded' ELSE 'queued' END AS status
        FROM {events}""",
    "v_updates": """
        SELECT 'proj_0' AS project_id, 'imp_' || CAST(user_id % 7 AS STRING) AS import_id,
          'images/' || CAST(event_id % 500 AS STRING) || '.jpg' AS relative_path,
          event_type IN ('purchase', 'view') AS uploaded, event_type = 'purchase' AS streamed,
          event_id, CAST(ts AS TIMESTAMP) AS ts, 'k/' || CAST(event_id AS STRING) AS object_key,
          CAST(NULL AS STRING) AS sha256, CAST(event_id * 10 AS BIGINT) AS size_bytes,
          CAST(NULL AS INT) AS width, CAST(NULL AS INT) AS height
        FROM {events}""",
    "v_tree": f"""
        SELECT doc_id, text, lang,
          CASE doc_id % 8
            WHEN 0 THEN 'images/' || source || '/' || CAST(doc_id AS STRING) || '.png'
            WHEN 1 THEN 'images/' || source || '/' || CAST(doc_id AS STRING) || '.BMP'
            WHEN 2 THEN 'images/' || source || '/' || CAST(doc_id AS STRING) || '.webp'
            WHEN 3 THEN 'images/' || source || '/' || CAST(doc_id AS STRING) || '.jpg'
            WHEN 4 THEN 'labels/' || source || '/' || CAST(doc_id - 4 AS STRING) || '.txt'
            WHEN 5 THEN '.hidden/' || CAST(doc_id AS STRING) || '.txt'
            WHEN 6 THEN 'notes/_' || CAST(doc_id AS STRING) || ' a%20b.md'
            ELSE '{STATE_DIR}/' || CAST(doc_id AS STRING) || '.json' END AS relative_path
        FROM {{documents}}""",
}


def _needed(text: str, found: dict[str, None]) -> dict[str, None]:
    for name in re.findall(r"\bv_[a-z_]+\b", text):
        if name in VIEWS and name not in found:
            _needed(VIEWS[name], found)
            found[name] = None
    return found


def with_views(sql: str) -> str:
    """``sql`` preceded by the definitions of the views it names."""
    names = _needed(sql, {})
    if not names:
        return sql
    body = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    return f"WITH {body} SELECT * FROM ({sql}) result"


def oracle(sql: str) -> str:
    """Complete DuckDB statement for a check that may use the views."""
    names = _needed(sql, {})
    if not names:
        return sql
    tables = {t: t for t in TABLES}
    body = ", ".join(f"{n} AS ({VIEWS[n].strip().format(**tables)})" for n in names)
    return f"WITH {body} SELECT * FROM ({sql}) result"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(
    spark: SparkSession, sf_dir: str, name: str, streams: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One view over the tables of ``sf_dir``; ``streams`` replaces tables by streams."""
    sql = with_views(f"SELECT * FROM {name}")
    used = {t for t in TABLES if f"{{{t}}}" in sql}
    given = streams or {}
    frames = {t: given[t] if t in given else table(spark, sf_dir, t) for t in used}
    return spark.sql(sql, **frames)
