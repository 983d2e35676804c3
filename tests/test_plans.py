"""Plan-level guards: no cross joins anywhere, filters reach the scan, and
the outlier query keeps its pass count."""

import re

import pytest

from panel_cases import SMALL
from panelsmith.plans import registry

registry.load_all()
ML = {
    "rf_cv", "feature_importance", "impute_forest", "impute_panel",
    "rf_cv_audit", "feature_importance_audit", "impute_forest_audit",
}


def _plan(spark, name):
    return registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - ML))
def test_no_cross_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_and_projection_reach_the_scan(spark):
    plan = registry.QUERIES["filter_range"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_exact_outliers_scan_three_times(spark):
    plan = _plan(spark, "iqr_outliers")
    assert len(re.findall(r"FileScan parquet|Scan parquet", plan)) <= 3
