"""Query of token-id files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import repair
from tidemark.llm.common import documents
from tidemark.llm.queries import query
from tidemark.shared import new_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token_files")
    repair.write_ids(
        documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), END_ID, path
    )
    return repair.read_ids(spark, path).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
