"""Every registered query against its SQL counterpart on the smallest tables (set SF_DIR for others)."""

from __future__ import annotations

import os

import pytest

from parity import compare, duck, plan_of
from tillworks.plans.oracle import oracle_sql
from tillworks.plans.queries import queries

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
# Numbering brings one row per written file together.
NUMBERED = {
    "surrogate_key", "incremental_ids", "fact_order", "build_inventory", "build_product", "build_customer", "build_address", "build_order",
}


@pytest.fixture(scope="module")
def oracle():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, oracle, name):
    result = queries()[name](spark, SF_DIR)
    rows, problems = compare(result, oracle, oracle_sql()[name])
    assert not problems
    assert rows > 0
    plan = plan_of(result)
    assert not [node for node in FORBIDDEN if node in plan]
    if name not in NUMBERED:
        assert "SinglePartition" not in plan.split("Subquery")[0]
