"""Plan checks: no cartesian products anywhere, Python workers only
where declared (the batched IRR solver and ML pipelines)."""

import pytest

from tests.conftest import SF_SMALL

PY_ALLOWED = {"f3_loan_irr", "f4_portfolio_irr", "f5_volume_irr_curve", "f7_irr_at_share", "f8_irr_by_group",
              "f14_secondary_irr", "f16_discount_sweep", "f6_compare_curves", "s6_parse_maps"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    import __spark_entry__ as E
    return sorted(E.REGISTRY)


@pytest.mark.parametrize("name", _names())
def test_plan_shape(spark, name):
    import __spark_entry__ as E
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in PY_ALLOWED and not name.startswith("ml_"):
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
