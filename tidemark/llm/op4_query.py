"""Query of personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import pii
from tidemark.llm.common import documents, keyed_text
from tidemark.llm.queries import query
from tidemark.llm.spans import count_kind, written


@query("op4_personal_data")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(keyed_text(documents(spark, sf_dir)))
    base = written(F.col("base"))
    added = written(F.col("found"))
    return found.select(
        F.col("id").alias("doc_id"),
        *(count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.when(base != "", base), F.when(added != "", added)).alias("spans"),
    )
