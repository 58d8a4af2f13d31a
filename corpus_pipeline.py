"""A corpus from documents to token ids, stage by stage.

Each stage takes what the one before kept and returns the columns of documents; the last returns
the digests of the encoded texts. Every result is written and read again; when a stage begins, the
tables that the stage before it had written for itself are removed.

* language: texts that are ``und`` or less sure than ``LEAST_SURE`` go.
* near_duplicates: of each component of near-copies the document with the smallest id stays; rows
  that repeat an id stay or go together.
* secrets: every secret found in a text is replaced by a mark; no document goes.
* mixing: all documents in the order of the schedule, which has the sources in the proportions of
  their tempered sizes; where one runs out, the others go on by their weights.
* encode: ids of the texts, and the texts that they spell.

A null or empty text, or one without a letter, is ``und`` and goes in the first stage; null ids and
sources stay what they are, rows with equal ids are kept or go together. Very long texts are taken whole.
Further columns pass through all stages but the last; names that begin with an underscore are the
stages' own. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, mixing, op9_query, secrets
from tidemark.llm.common import documents, keyed_text
from tidemark.shared import remove, write_and_read, written_tables

LEAST_SURE = 0.5


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(language.learning_rows(docs))
    found = language.predict(docs, model)
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SURE)
    return found.where(sure).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.join(docs)
    others = found.where(F.col("id") != F.col("component")).select(F.col("id").alias("doc_id"))
    return docs.join(write_and_read(others.distinct(), "duplicates"), "doc_id", "left_anti").select(
        *docs.columns
    )


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    versions = keyed_text(docs)
    ledger = write_and_read(secrets.scan(versions, secrets.empty_ledger(versions)), "ledger")
    clean = secrets.redact(docs, ledger)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = mixing.mix(docs.select("doc_id", "source"))
    plan = plan.groupBy("doc_id", "source").agg(F.min("_slot").alias("_slot"))
    plan = plan.withColumnsRenamed({"doc_id": "_id", "source": "_from"})
    same = docs["doc_id"].eqNullSafe(plan["_id"]) & docs["source"].eqNullSafe(plan["_from"])
    rows = docs.join(plan, same)
    return rows.repartitionByRange("_slot").sortWithinPartitions("_slot", "doc_id").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_query.digests(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_SPENT: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """``stage``, which has its predecessor's own tables removed: what that returned is written by now."""

    @wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _SPENT:
            remove(spark, _SPENT.pop())
        with written_tables() as made:
            out = stage(spark, docs, sf_dir)
        _SPENT.extend(made)
        return out

    return begin


STAGES = [
    ("language", _tidy(by_language)),
    ("near_duplicates", _tidy(near_duplicates)),
    ("secrets", _tidy(without_secrets)),
    ("mixing", _tidy(mixed)),
    ("encode", _tidy(encode)),
]

#: Language identification and BPE are not SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), name)
    return docs
