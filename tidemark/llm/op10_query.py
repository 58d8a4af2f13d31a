"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.common import documents
from tidemark.llm.queries import query

SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
g AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < {jaccard.WIDTH} THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - {jaccard.WIDTH - 2}),
      lambda i: array_to_string(ws[i:i + {jaccard.WIDTH - 1}], ' ')) END)) AS s FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= {jaccard.PERCENT} * (x.n + y.n - c)
),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM r JOIN both_ways t ON r.b = t.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
  least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = d.doc_id
"""


@query("op10_jaccard", SQL)
def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.join(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )
