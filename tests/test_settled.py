"""Inputs of fits: written once, in parts by their rows."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import learn as L
from quarry.plans import learn as P
from tests.conftest import SF_SMALL


class Seen(Exception):
    """Carries what a step was given."""


def given(monkeypatch, name, call):
    def stop(df, *args, **kwargs):
        raise Seen(df)

    monkeypatch.setattr(L, name, stop)
    with pytest.raises(Seen) as found:
        call()
    return found.value.args[0]


def check_settled(df):
    assert df.rdd.getNumPartitions() == 1
    assert all("fit-rows" in f for f in df.inputFiles())


def test_settled_keeps_all_rows_in_parts_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(L, "PART_ROWS", 100)
    df = spark.range(0, 950, 1, 8).withColumn("x", F.col("id") * 2)
    out = L.settled(df)
    assert sorted(map(tuple, out.collect())) == [(i, 2 * i) for i in range(950)]
    monkeypatch.setattr(L, "PART_ROWS", 475)
    assert L.settled(df).rdd.getNumPartitions() == 2
    assert L.settled(df.filter("id < 0")).count() == 0


def test_cv_search_fits_on_written_days(spark):
    check_settled(P._day_data(spark, SF_SMALL))


def test_model_floors_fits_on_written_days(spark, monkeypatch):
    check_settled(given(monkeypatch, "holdout_split", lambda: P.q_model_floors(spark, SF_SMALL)))


def test_classifiers_fit_on_written_vectors(spark, monkeypatch):
    check_settled(given(monkeypatch, "holdout_split", lambda: P.q_clf_svc(spark, SF_SMALL)))


def test_rating_model_fits_on_written_features(spark, monkeypatch):
    class Fit:
        def setLabelCol(self, name):
            return self

        def fit(self, df):
            raise Seen(df)

    monkeypatch.setattr(L, "reg_boosted", lambda **kwargs: Fit())
    with pytest.raises(Seen) as found:
        P.q_rating_prediction(spark, SF_SMALL)
    check_settled(found.value.args[0])
