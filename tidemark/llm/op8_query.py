"""Query of document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import documents
from tidemark.llm.queries import query
from tidemark.shared import write_and_read


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_near`` counts the other documents within ``simhash.RADIUS`` bits, for every 50th id;
    else null."""
    rows = write_and_read(simhash.edited_pairs(documents(spark, sf_dir)))
    asked = rows.where(F.col("id") % 50 == 0).select("id", "fingerprint")
    near = simhash.count_likely(rows.select("fingerprint"), asked)
    near = asked.join(near, "fingerprint").select("id", (F.col("n_near") - 1).alias("n_near"))
    return rows.join(near, "id", "left").select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "n_near",
    )
