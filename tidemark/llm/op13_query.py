"""Query of conversation structure repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import turns
from tidemark.llm.queries import query


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.figures(turns.repair(turns.damage(rows)), rows)
