"""Query of BPE encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import documents
from tidemark.llm.queries import query

VOCABULARY = "byte_bpe_50k.json"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    path = public_tokenizers.path(VOCABULARY)
    decoded = bpe.round_trip(docs, path)
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
