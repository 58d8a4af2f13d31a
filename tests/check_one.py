"""Run queries and their SQL side by side: ``python tests/check_one.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from tidemark.plans.views import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        return _cell(value.item())
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_cell(v) for v in r) for r in frame.itertuples(index=False)), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs."""
    got = entry_module.queries()[name](spark, sf_dir).toPandas()
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return None if len(got) else "no rows"
    want = con.execute(sql).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    a, b = rows_of(got), rows_of(want)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(diff)} rows differ, first {diff[0]}" if diff else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(sf)
    wrong = 0
    for query_name in sys.argv[2:] or entry_module.queries():
        begun = time.monotonic()
        try:
            problem = compare(session, connection, sf, query_name)
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        wrong += problem is not None
        checked = "sql" if query_name in entry_module.oracle_sql() else "rows"
        print(f"{query_name:28} {checked:5}{time.monotonic() - begun:6.2f}s {problem or 'ok'}", flush=True)
    print("wrong:", wrong)
    sys.exit(wrong > 0)
