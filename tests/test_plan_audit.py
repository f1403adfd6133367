"""Every (non-staging, non-training) registered query: no cartesian or
nested-loop joins, no Python stage at all."""

import pytest

import __spark_entry__ as E
from conftest import SF001

SLOW = ("M4", "M5", "M6", "M8", "A14", "S1_", "S3", "S4", "S5", "S6", "S8", "S10", "S11", "S12",
        "S15", "S16", "S17", "A12", "J2_upsert_tables", "J2_stream")
NAMES = sorted(n for n in E.LISTING_QUERIES if not n.startswith(SLOW))


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_cross_join_or_python_rows(spark, name):
    df = E.queries()[name](spark, SF001)
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan().toString() + qe.optimizedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, (name, bad)
    assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan, name
