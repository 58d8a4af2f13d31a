"""Query of mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.common import documents
from tidemark.llm.queries import query

SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS code
  FROM documents
),
n AS (
  SELECT doc_id, source, s, row_number() OVER (PARTITION BY s ORDER BY code, doc_id) - 1 AS k FROM d
),
z AS (SELECT s, count(*) AS n FROM d GROUP BY s),
w AS (
  SELECT s, n, greatest(1, CAST(round(pow(n, {mixing.TEMPER}) / sum(pow(n, {mixing.TEMPER})) OVER ()
    * greatest({mixing.RESOLUTION}, {mixing.PER_SOURCE} * count(*) OVER ())) AS BIGINT)) AS w FROM z
),
p AS (
  SELECT list(s ORDER BY s) AS ss, list(w ORDER BY s) AS ws, CAST(sum(w) AS BIGINT) AS r FROM w
),
edf(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM p
  UNION ALL
  SELECT t + 1, list_transform(done, lambda c, j: CASE WHEN j = best THEN c + 1 ELSE c END), best
  FROM (
    SELECT t, done, list_position(due, list_min(due)) AS best FROM (
      SELECT t, done, r, list_transform(list_zip(ws, done), lambda x: CASE
        WHEN x[2] < x[1] AND floor(x[2] * r / x[1]) <= t + 1
        THEN CAST(ceil((x[2] + 1) * r / x[1]) AS BIGINT) END) AS due
      FROM edf, p WHERE t + 1 < r
    )
  )
),
o AS (
  SELECT ss[pick] AS s, t AS off, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS i
  FROM edf, p WHERE t >= 0
),
h AS (
  SELECT min((CAST(ceil(n / {mixing.BLOCK}) AS BIGINT) // w.w) * r + off) AS horizon
  FROM w JOIN o ON o.s = w.s AND o.i = CAST(ceil(n / {mixing.BLOCK}) AS BIGINT) % w.w, p
),
b AS (
  SELECT doc_id, source, w.w AS w, r, k // {mixing.BLOCK} AS block, o.off AS off
  FROM n JOIN w ON n.s = w.s JOIN o ON o.s = n.s AND o.i = (k // {mixing.BLOCK}) % w.w, p
)
SELECT doc_id, source, block, CAST(floor(block * r / w) AS BIGINT) AS release,
  CAST(ceil((block + 1) * r / w) AS BIGINT) AS deadline, (block // w) * r + off AS slot,
  (block // w) * r + off < horizon AS mixed
FROM b, h
"""


@query("op5_mixing", SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "source"))
    names = ("block", "release", "deadline", "slot", "mixed")
    return mixed.select("doc_id", "source", *(F.col(f"_{n}").alias(n) for n in names))
