"""Cleaning and statistics operators on small hand-made inputs."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import clean as C
from quarry.operators import stats as ST


def test_null_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, None)], "a int, b string")
    got = {r.column_name: (r.null_count, r.row_count) for r in C.null_profile(df).collect()}
    assert got == {"a": (2, 3), "b": (2, 3)}


def test_strip_unit_and_bmi(spark):
    df = spark.createDataFrame([("170cm", 70), (" 180 cm ", 81), ("tall", 60), ("0cm", 50)], "h string, w int")
    out = df.select(C.strip_unit(F.col("h"), "cm").alias("cm"),
                    C.ratio_feature(F.col("w"), C.strip_unit(F.col("h"), "cm")).alias("bmi")).collect()
    assert [r.cm for r in out] == [170.0, 180.0, None, 0.0]
    assert abs(out[0].bmi - 70 / 1.7 ** 2) < 1e-12 and out[2].bmi is None and out[3].bmi is None


def test_tokens_multi_hot_and_count(spark):
    df = spark.createDataFrame([(1, "b, a"), (2, None), (3, ""), (4, "a,,c")], "id int, s string")
    dictionary = [r.token for r in C.token_dictionary(df, "s").collect()]
    assert dictionary == ["a", "b", "c"]
    hot = {r.id: (r.t_a, r.t_b, r.t_c) for r in C.multi_hot(df, "s", dictionary, "t_").collect()}
    assert hot == {1: (1, 1, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (1, 0, 1)}
    counts = {r.id: r.n for r in df.select("id", C.token_count(F.col("s")).alias("n")).collect()}
    assert counts == {1: 2, 2: 0, 3: 0, 4: 2}


def test_multi_hot_of_twelve_thousand_tokens(spark):
    many = [f"t{i:05d}" for i in range(12_000)]
    df = spark.createDataFrame([(1, ",".join(many)), (2, "t11999, t00000"), (3, None), (4, "")], "id int, s string")
    got = {r.id: r.indices for r in C.multi_hot_indices(df, "s").collect()}
    assert got[1] == list(range(12_000)) and got[2] == [0, 11_999] and got[3] == got[4] == []


def test_whole_years_floor_for_negative_gaps(spark):
    df = spark.createDataFrame([(-1,), (364,), (365,), (-366,)], "d int")
    assert [r[0] for r in df.select(C.whole_years(F.col("d"))).collect()] == [-1, 0, 1, -2]


def test_minmax_constant_and_range(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "x double")
    assert [r.x_scaled for r in C.minmax_scale(df, "x", -1.0, 1.0).orderBy("x").collect()] == [-1.0, 0.0, 1.0]
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r.x_scaled for r in C.minmax_scale(const, "x").collect()} == {0.0}


def test_density_histogram_last_bin_closed_and_integrates_to_one(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = ST.density_histogram(df, "x", bins=5).orderBy("bin").toPandas()
    assert h["count"].tolist() == [2, 2, 2, 2, 3]
    width = 2.0
    assert abs((h["density"] * width).sum() - 1.0) < 1e-6


def test_outcome_summary_matches_numpy(spark):
    vals = [3.0, -1.0, 4.0, 1.0, -5.0, 9.0]
    df = spark.createDataFrame([("g", v) for v in vals], "grp string, x double")
    r = ST.outcome_summary(df, "grp", "x").first()
    s = pd.Series(vals)
    assert r.mean == pytest.approx(s.mean())
    assert r.sd == pytest.approx(s.std(ddof=0))
    assert r.se == pytest.approx(s.std(ddof=0) / math.sqrt(len(vals)))


def test_describe_matches_pandas(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 7.0, 11.0, 13.0]
    df = spark.createDataFrame([(0, v, v * 2) for v in vals], "grp int, a double, b double")
    got = {r.metric: r for r in ST.describe_by_group(df, "grp", ["a", "b"]).collect()}
    d = pd.Series(vals).describe()
    a = got["a"]
    assert (a["count"], a["min"], a["max"]) == (d["count"], d["min"], d["max"])
    assert (a.q25, a.q50, a.q75) == pytest.approx((d["25%"], d["50%"], d["75%"]))
    assert a.std == pytest.approx(d["std"])
    approx = ST.describe_by_group(df, "grp", ["a"], exact=False).first()
    assert approx["count"] == 7


def test_correlation_pairs_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, 5], "b": [2.0, 1, 4, 3, 5], "c": [5.0, 3, 2, 2, 1]})
    got = {(r.col_a, r.col_b): r.corr for r in ST.correlation_pairs(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    want = pdf.corr()
    for (x, y), v in got.items():
        assert abs(v - want.loc[x, y]) < 1e-6


def test_spread_and_pvalue(spark):
    df = spark.createDataFrame([(100.0, 40.0, 50.0), (300.0, 45.0, 48.0)], "n double, a double, b double")
    s = ST.spread_pvalue(ST.spread(df, "n", "a", "b")).first()
    va, vb = (100 * 40 + 300 * 45) / 100, (100 * 50 + 300 * 48) / 100
    pb = vb / (va + vb)
    sd = 2 * math.sqrt(pb * (1 - pb) / (va + vb))
    assert abs(s.d - (2 * pb - 1)) < 1e-9 and abs(s.sd - sd) < 1e-9
    assert abs(s.p_value - math.erfc(abs((2 * pb - 1) / sd) / math.sqrt(2))) < 1e-6
