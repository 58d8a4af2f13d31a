"""Query of language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.common import documents
from tidemark.llm.queries import query


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit(language.learning_rows(docs))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "row.doc_id",
        language.is_held_out(F.col("row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )
