"""What the plans of the operators for training data must not contain."""

from __future__ import annotations

import pytest

import corpus_pipeline
from roadpulse.llm.queries import QUERIES

PLANS = {**QUERIES, "pipeline": corpus_pipeline.run}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_cross_joins_and_no_python_by_row(spark, small, name):
    plan = PLANS[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonRunner"):
        assert node not in plan
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    if name in ("op4_pii", "op5_imatch"):
        assert "MapInArrow" not in plan and "InPandas" not in plan
