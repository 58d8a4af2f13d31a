"""Query of exact top-k search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import kdtree
from tidemark.llm.queries import query

SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_inner_product(q.v, c.v), 0) AS BIGINT) AS score
  FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
),
k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 10
"""


@query("op11_topk", SQL)
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return kdtree.top_k(rows, F.col("id") % 100 == 0)
