"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable:
    """Register a query; ``check`` is DuckDB SQL over the same tables."""

    def add(function: Callable) -> Callable:
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return add
