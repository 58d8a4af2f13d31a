"""Importing this registers every query."""

from __future__ import annotations

from tidemark.plans import (  # noqa: F401
    dataset_queries,
    scalar_queries,
    source_queries,
    streaming_queries,
    transfer_queries,
)
from tidemark.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
