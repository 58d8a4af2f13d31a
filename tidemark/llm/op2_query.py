"""Query of suffix-array deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import suffixes
from tidemark.llm.common import documents
from tidemark.llm.queries import query


@query("op2_repeats")
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
