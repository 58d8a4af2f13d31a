"""Every query of the subpackage runs; those with SQL equal it."""

from __future__ import annotations

import pytest
from check_one import compare, duck

from tidemark.llm.all_queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, duck(SF), SF, name) is None


def test_all_are_there():
    numbers = {name.split("_")[0] for name in QUERIES}
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == numbers
    assert set(CHECKS) == {"op1_secrets", "op5_mixing", "op10_jaccard", "op11_topk", "op12_hard_negatives"}
