"""Plan shape: map-side combine, pushed filters, no single-partition row
window, no cross or nested-loop joins."""

import re

import pytest

from lendlens.operators import cohorts
from lendlens.plans.catalog import QUERIES
from lendlens.sources import fixtures as fx

COHORT_QUERIES = ["age_band", "income_type", "employment_band", "enquiry_band",
                  "contract_realty", "family_children", "weekday", "cohort_report",
                  "risk_level_summary"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", COHORT_QUERIES)
def test_aggregation_is_combined_map_side(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "partial_count" in plan
    # the partial aggregate sits below the first shuffle on the keys
    assert plan.rindex("partial_count") > plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fit_risk_model", "score_portfolio"}))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_amount_filters_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan text
    try:
        plan = _plan(cohorts.analyse(fx.applications(spark, sf_dir), 3,
                                     min_credit=1000, max_credit=9e5))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in pushed
    assert "LessThanOrEqual(o_totalprice,900000.0)" in pushed


def test_quintile_has_no_single_partition_row_window(spark, sf_dir):
    df = cohorts.analyse(fx.applications(spark, sf_dir), 2)
    plan = _plan(df)
    # windows without a partition key read the bucket table (sums per
    # bucket), never the rows; rows are only numbered within an id range
    windows = re.findall(r"Window \[[^\n]*", plan)
    assert windows
    for w in windows:
        assert w.startswith("Window [sum(n") or "row_number() windowspecdefinition(b" in w


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fit_risk_model", "score_portfolio",
                                                             "feedback_stream"}))
def test_no_python_evaluation(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_scoring_plan_stays_in_the_jvm(spark, sf_dir, tmp_path):
    from lendlens.operators import scoring
    pre, model, _ = scoring.fit_risk_model(fx.applications(spark, sf_dir), path=str(tmp_path / "m"))
    plan = _plan(scoring.score(fx.applicants(spark, sf_dir), pre, model))
    assert "EvalPython" not in plan and "PythonUDF" not in plan
