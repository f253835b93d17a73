"""Physical-plan guards: no cross products, no row-at-a-time Python UDFs,
column pruning and a single shuffle for the flagship report."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

STREAMS = {"window_top_merchants"}
MODELS = {"clf_logistic", "clf_svc", "clf_forest", "clf_boosted", "cv_search", "cv_score", "holdout_search",
          "group_models", "reg_boosted", "reg_forest", "feature_importance", "rating_prediction", "rating_prediction_khop", "model_metrics", "clf_svc_rbf", "model_floors"}
# training-data queries have tests of their own
KEYS = sorted(k for k in E.queries() if not re.match(r"stream_|op\d+_|pipeline$", k) and k not in STREAMS | MODELS)
FORBIDDEN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_products_or_row_udfs(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert not FORBIDDEN.search(plan), plan


def test_flagship_plan_prunes_columns_and_shuffles_once(spark):
    df = E.queries()["merchant_category_summary"](spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan
    assert "partial_sum" in plan  # map-side partial aggregation before the shuffle


def test_ingest_parses_each_message_once(spark):
    plan = _plan(E.queries()["ingest_valid"](spark, SF_SMALL))
    assert plan.count("from_json(") == 1, plan


@pytest.mark.parametrize("key, scans", [("category_rank_flags", 1), ("density_histogram", 2), ("describe_by_group", 2)])
def test_number_of_scans_without_broadcasts(spark, key, scans):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()[key](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") <= scans, plan
