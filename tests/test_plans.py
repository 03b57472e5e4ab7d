"""Plan checks: no row-at-a-time Python, and any single-partition exchange
carries only partial aggregates or a limit, never table rows."""

import re

import pytest

from tests.conftest import SF001

# every registered query except the model fits (their plans are MLlib's own) and the chain of all stages
HEAVY = {"random_search", "recursive_forecast", "rf_metrics", "gbt_metrics", "linear_metrics", "pipeline_predict",
         "var_select", "var_coefficients", "var_forecast", "var_forecast_by", "model_comparison_var_trees", "pipeline"}


def _keys():
    import __spark_entry__ as E
    return sorted(k for k in E.queries() if k not in HEAVY)


KEYS = _keys()


@pytest.fixture(scope="module")
def registry():
    import __spark_entry__ as E
    return E.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_plan_is_jvm_side_and_never_funnels_rows(spark, registry, key):
    plan = _plan(registry[key](spark, SF001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"Exchange SinglePartition", line):
            child = lines[i + 1] if i + 1 < len(lines) else ""
            assert re.search(r"Aggregate|Limit|TakeOrdered", child), f"{key}: rows funnel into one partition:\n{line}\n{child}"


def test_top_k_per_group_uses_partial_group_limit(spark, registry):
    plan = _plan(registry["last_n_by_user"](spark, SF001))
    assert "WindowGroupLimit" in plan
