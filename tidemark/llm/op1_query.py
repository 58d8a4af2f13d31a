"""Query of secret scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.common import documents, keyed_text
from tidemark.llm.queries import query
from tidemark.llm.spans import count_kind, written
from tidemark.shared import write_and_read


def _sql() -> str:
    """Each kind's matches and what lies between them; their lengths give the places."""
    kinds = "\nUNION ALL\n".join(
        f"SELECT doc_id, {order} AS o, '{r.name}' AS kind, "
        + "CAST("
        + (
            f"list_transform(hits, lambda h: regexp_matches(h, '{_quoted(r.must)}'))"
            if r.must
            else "list_transform(hits, lambda h: true)"
        )
        + " AS BOOLEAN[]) AS good, hits, gaps FROM (SELECT doc_id, "
        f"regexp_extract_all(t, '{_quoted(r.plain or r.pattern)}') AS hits, "
        f"string_split_regex(t, '{_quoted(r.plain or r.pattern)}') AS gaps FROM d) WHERE len(hits) > 0"
        for order, r in enumerate(secrets.RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({kinds}),
u AS (
  SELECT doc_id, o, kind, unnest(range(1, len(hits) + 1)) AS n, hits, gaps, good FROM k
),
l AS (
  SELECT doc_id, o, kind, n, good[n] AS good, length(gaps[n]) AS g, length(hits[n]) AS h FROM u
),
s AS (
  SELECT doc_id, o, kind, good,
    CAST(sum(g + h) OVER (PARTITION BY doc_id, o ORDER BY n) AS BIGINT) AS stop, h FROM l
),
f AS (
  SELECT doc_id, o, kind, kind || ':' || (stop - h) || ':' || stop AS span, stop - h AS start
  FROM s WHERE good
),
a AS (
  SELECT doc_id,
    count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, o) FILTER (o < {len(secrets.BASE)}) AS base,
    string_agg(span, ',' ORDER BY start, o) AS spans
  FROM f GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


@query("op1_secrets", _sql())
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = keyed_text(documents(spark, sf_dir))
    # The ledger grows as it does over time: base rules first, then only what it lacks of all rules.
    base_rows = secrets.scan(versions, secrets.empty_ledger(versions), secrets.BASE)
    ledger = write_and_read(base_rows, "ledger")
    ledger = ledger.unionByName(write_and_read(secrets.scan(versions, ledger), "ledger"))
    found = secrets.findings(versions, ledger)
    kinds = [r.name for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    counts = [count_kind(F.col("spans"), kind).alias(f"n_{kind}") for kind in kinds]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
