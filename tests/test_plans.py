"""Scale guard: no registered query plans a cartesian product or a
nested-loop join (containment, suggestions and summaries must stay equi-joins)."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# model fits and sweeps build many plans; their joins are the same operators
SKIP = {"sweep_bins", "sweep_ranking", "best_config", "rf_grid", "rf_importance", "rf_evaluate", "model_summary", "disease_topk",
        "tumour_predict", "strategy_summary", "session_stream", "triage_disease"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SKIP))
def test_no_nested_loop_or_cartesian(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
