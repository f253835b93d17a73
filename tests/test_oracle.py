"""Every registered query with SQL equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.helpers import assert_same

# fits of minutes; the driver's check and scripts/check_oracle.py run them too
SLOW = {"clf_boosted", "clf_svc", "cv_search", "cv_score", "group_boosted", "group_models", "rating_prediction", "rating_prediction_khop", "holdout_search", "reg_boosted", "reg_forest", "feature_importance", "clf_svc_rbf", "model_floors"}
SQL = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(set(SQL) - SLOW))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = duck.sql(SQL[key])
    # same column names and Arrow types ...
    got_types = {f.name: str(f.type) for f in df.toArrow().schema}
    want_types = {f.name: str(f.type) for f in rel.arrow().schema}
    assert got_types == want_types
    # ... and the same rows, in any order
    assert_same(df.toPandas(), rel.df())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert "total_commissions" in df.columns


def test_every_key_is_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 120
