"""Plan properties of every SQL-checked query (sf0.001)."""

import pytest

from noteledger.plans.catalog import QUERIES

from .conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_scans_are_pruned(spark):
    plan = _plan(QUERIES["quality_summary"](spark, SF_SMALL))
    assert "struct<doc_id:bigint,text:string>" in plan
    plan = _plan(QUERIES["category_distribution"](spark, SF_SMALL))
    assert "struct<lang:string>" in plan
