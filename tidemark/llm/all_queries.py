"""Importing this registers every query of the subpackage."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import (  # noqa: F401
    op1_query,
    op10_query,
    op11_query,
    op12_query,
    op13_query,
    op2_query,
    op3_query,
    op4_query,
    op5_query,
    op6_query,
    op7_query,
    op8_query,
    op9_query,
)
from tidemark.llm.queries import CHECKS, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["CHECKS", "QUERIES"]
