"""Query of hard-negative mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import hardneg
from tidemark.llm.queries import query

SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.r, a.vec_id AS anchor_id, c.r AS other, c.vec_id, a.label = c.label AS same,
    CAST(coalesce(list_inner_product(a.v, c.v), 0) AS BIGINT) AS score
  FROM e a JOIN e c ON a.r <> c.r AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0
),
p AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same
),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.r = p.r AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""


@query("op12_hard_negatives", SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hardneg.mine(rows, F.col("id") % 50 == 0, moved)
