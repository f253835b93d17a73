"""Edge cases and known answers."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import tails
from quarry.functions.holidays import holiday_calendar
from quarry.operators import clean as C
from quarry.operators import fraud as FR
from quarry.operators import graph as G
from quarry.operators import ingest as I
from quarry.operators import joins as J
from quarry.operators import reports as R
from quarry.operators import stats as ST
from quarry.operators import summary as SU
from tests.helpers import rows

TX_SCHEMA = ("transaction_id string, event_time timestamp, customer_id string, merchant_id string, "
             "merchant_category string, payment_method string, amount long, status string, commission_type string, "
             "commission_amount long, vat_amount long, total_amount long, customer_type string, risk_level int, "
             "failure_reason string, location_lat double, location_lng double, device_os string, "
             "device_app_version string, device_model string")


def tx_rows(spark, data):
    """data: list of (id, 'YYYY-mm-dd HH:MM:SS', customer, total, status, lat, lng)."""
    rows_ = []
    for tid, ts, cust, total, status, lat, lng in data:
        rows_.append((tid, dt.datetime.fromisoformat(ts), cust, "m1", "retail", "pos", total, status, "flat",
                      total // 50, 0, total, "individual", 1, None, lat, lng, None, None, None))
    return spark.createDataFrame(rows_, TX_SCHEMA)


def test_zero_total_ratio_is_null(spark):
    df = tx_rows(spark, [("1", "2024-01-01 00:00:00", "c", 0, "approved", 0.0, 0.0)])
    out = R.merchant_category_summary(df).first()
    assert out["commission_to_transaction_ratio"] is None


def test_empty_input_gives_empty_report(spark):
    df = tx_rows(spark, []).limit(0)
    assert R.customer_summary(df).count() == 0


def test_null_group_key_is_its_own_group(spark):
    df = tx_rows(spark, [("1", "2024-01-01 00:00:00", None, 100, "approved", 0.0, 0.0),
                         ("2", "2024-01-01 00:01:00", "c", 100, "approved", 0.0, 0.0)])
    assert R.customer_summary(df).count() == 2


def test_single_row_group_sample_variance_is_null(spark):
    r = spark.createDataFrame([(1, 1, 4.0)], "user_id long, item_id long, label double")
    assert G.item_rating_stats(r).first()["variance_rating"] is None


def test_unknown_label_maps_to_null(spark):
    df = spark.createDataFrame([(" Yes ",), ("maybe",), (None,)], "v string")
    out = [r[0] for r in df.select(C.map_codes(F.col("v"), {"yes": 1, "no": 0})).collect()]
    assert out == [1, None, None]


def test_duplicate_ids_inserted_once(spark):
    b = spark.createDataFrame([("1", 1), ("1", 1), ("2", 2)], "id string, v int")
    t = spark.createDataFrame([("2", 2)], "id string, v int")
    assert sorted(r["id"] for r in J.append_new(b, t, "id").collect()) == ["1"]


def test_interval_join_borders(spark):
    # gap exactly 5 minutes is included, 0 minutes excluded, 5 min + 1 us excluded
    df = tx_rows(spark, [
        ("a", "2024-01-01 00:04:59", "c", 100, "approved", 35.0, 51.0),
        ("b", "2024-01-01 00:09:59", "c", 100, "approved", 36.0, 51.0),   # +5:00 from a
        ("c", "2024-01-01 00:09:59", "c", 100, "approved", 37.0, 51.0),   # +0 from b
        ("d", "2024-01-01 00:15:00", "c", 100, "approved", 38.0, 51.0),   # +5:01 from c
    ])
    got = sorted((r.tx_id_1, r.tx_id_2) for r in FR.geo_alerts(df).collect())
    assert got == [("a", "b"), ("a", "c")]


def test_distance_exactly_at_threshold_not_flagged(spark):
    df = tx_rows(spark, [("a", "2024-01-01 00:00:00", "c", 1, "approved", 0.0, 0.0),
                         ("b", "2024-01-01 00:01:00", "c", 1, "approved", 0.5, 0.0)])
    assert FR.geo_alerts(df).count() == 0


def test_interval_join_equals_brute_force(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from quarry.sources.fixtures import transactions_from_events

    tx = transactions_from_events(ev).toPandas()
    pairs = FR.geo_alerts(transactions_from_events(ev), threshold=-1.0).select("tx_id_1", "tx_id_2").toPandas()
    brute = []
    for _, g in tx.groupby("customer_id"):
        g = g.sort_values("event_time")
        for i, a in g.iterrows():
            for j, b in g.iterrows():
                if a.event_time < b.event_time <= a.event_time + pd.Timedelta(minutes=5):
                    brute.append((a.transaction_id, b.transaction_id))
    assert sorted(map(tuple, pairs.values.tolist())) == sorted(brute)


def test_top_k_ties_broken_by_key(spark):
    s = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), ("d", 1)], "merchant_id string, total_trxs long")
    got = [r.merchant_id for r in R.top_by_count(s, "merchant_id", k=2).orderBy("rank").collect()]
    assert got == ["a", "b"]


def test_iso_week_year_turn(spark):
    df = tx_rows(spark, [("1", "2024-12-30 10:00:00", "c", 100, "approved", 0.0, 0.0),
                         ("2", "2025-01-06 10:00:00", "c", 300, "approved", 0.0, 0.0)])
    cal = {(r.year, r.week_of_year) for r in R.weekly_change(df).collect()}
    assert cal == {(2024, 1), (2025, 2)}  # reference behaviour: calendar year x ISO week
    iso = {(r.year, r.week_of_year) for r in R.weekly_change(df, iso_year=True).collect()}
    assert iso == {(2025, 1), (2025, 2)}


def test_part_of_day_null_hour(spark):
    from quarry.functions.calendar import part_of_day

    df = spark.createDataFrame([(None,), (0,), (6,), (12,), (18,), (23,)], "h int")
    assert [r[0] for r in df.select(part_of_day(F.col("h"))).collect()] == [
        None, "Night", "Morning", "Afternoon", "Evening", "Evening"]


def test_validation_codes_one_by_one(spark):
    base = dict(payment_method="pos", device_os=None, amount=1000, vat_amount=90, commission_amount=20,
                total_amount=1090, event_time=dt.datetime(2024, 1, 2, 12), record_timestamp=dt.datetime(2024, 1, 2, 13))
    cases = [
        ({}, None),
        ({"payment_method": "mobile", "device_os": "Symbian"}, "ERR_DEVICE"),
        ({"payment_method": "mobile", "device_os": None}, "ERR_DEVICE"),
        ({"payment_method": "mobile", "device_os": "iOS"}, None),
        ({"total_amount": 1091}, "ERR_AMOUNT"),
        ({"event_time": dt.datetime(2024, 1, 2, 14)}, "ERR_TIME"),                      # future
        ({"event_time": dt.datetime(2023, 12, 31, 12)}, "ERR_TIME"),                    # > 1 day old
        ({"payment_method": "mobile", "device_os": "x", "total_amount": 1}, "ERR_DEVICE"),  # first rule wins
    ]
    schema = ("payment_method string, device_os string, amount long, vat_amount long, commission_amount long, "
              "total_amount long, event_time timestamp, record_timestamp timestamp")
    data = [tuple({**base, **c}[k] for k in base) for c, _ in cases]
    got = [r.error_code for r in I.validate(spark.createDataFrame(data, schema)).collect()]
    assert got == [want for _, want in cases]
    ref = I.validate(spark.createDataFrame([data[0]], schema), amount_includes_commission=True).first()
    assert ref.error_code == "ERR_AMOUNT"  # quirk Q3: the reference rule rejects every row with commission


def test_malformed_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.123Z",), ("not a time",), ("2024-01-01T00:00:00Z",),
                                ("2024-01-01T00:00:00.123456Z",), ("2024-01-01T00:00:00.5",)], "s string")
    got = [r[0] for r in df.select(I.parse_ts(F.col("s"))).collect()]
    day = dt.datetime(2024, 1, 1)
    assert got == [day.replace(microsecond=123000), None, day, day.replace(microsecond=123456), day.replace(microsecond=500000)]


def test_khop_cycle_self_loop_and_depth_beyond_diameter(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 3), (4, 4)], "trustor long, trustee long")
    src = spark.createDataFrame([(1,), (4,)], "user_id long")
    got = sorted(tuple(r) for r in G.khop_reach(edges, src, max_depth=50).collect())
    assert got == [(1, 2, 1), (1, 3, 2)]


def test_khop_equals_bfs(spark):
    import random
    from collections import deque

    rnd = random.Random(7)
    e = [(rnd.randrange(30), rnd.randrange(30)) for _ in range(70)]
    edges = spark.createDataFrame(e, "trustor long, trustee long")
    src = spark.createDataFrame([(u,) for u in range(30)], "user_id long")
    got = {(r.src, r.dst): r.hops for r in G.khop_reach(edges, src, max_depth=4).collect()}
    adj = {}
    for a, b in e:
        adj.setdefault(a, []).append(b)
    want = {}
    for u in range(30):
        seen, q = {u}, deque([(u, 0)])
        while q:
            cur, d = q.popleft()
            if d >= 4:
                continue
            for nb in adj.get(cur, []):
                if nb not in seen:
                    seen.add(nb)
                    want[(u, nb)] = d + 1
                    q.append((nb, d + 1))
    assert got == want


def test_known_answer_interval():
    # p = .47, n = 30 -> [0.2914, 0.6486]
    half = 1.959963984540054 * math.sqrt(0.47 * 0.53 / 30)
    assert round(0.47 - half, 4) == 0.2914 and round(0.47 + half, 4) == 0.6486


def test_known_answer_tails():
    # two-sided 5 % and 10 % critical values for 9125 degrees of freedom: 1.962 and 1.646
    assert abs(tails.t_two_sided(1.9602, 9125) - 0.05) < 1e-3
    assert abs(tails.t_two_sided(1.6450, 9125) - 0.10) < 1e-3
    assert abs(tails.normal_two_sided(1.959963984540054) - 0.05) < 1e-12
    # small-dof check against a closed form: t with 1 dof is Cauchy
    assert abs(tails.t_two_sided(1.0, 1.0) - 0.5) < 1e-12


def test_welch_matches_hand_computation(spark):
    data = [(1, float(v)) for v in [1, 2, 3, 4, 10]] + [(0, float(v)) for v in [2, 2, 3, 3, 3, 4]]
    df = spark.createDataFrame(data, "grp int, v double")
    r = ST.welch(df, "grp", ["v"], 1, 0).first()
    a, b = pd.Series([1, 2, 3, 4, 10.0]), pd.Series([2, 2, 3, 3, 3, 4.0])
    va, vb = a.var() / 5, b.var() / 6
    assert abs(r.t_stat - (a.mean() - b.mean()) / math.sqrt(va + vb)) < 1e-9
    assert abs(r.dof - (va + vb) ** 2 / (va ** 2 / 4 + vb ** 2 / 5)) < 1e-9


def test_holiday_rules_known_dates(spark):
    d = spark.createDataFrame([(dt.date(1998, 6, 1),), (dt.date(2022, 6, 1),)], "date date")
    cal = {(r.date, r.name) for r in holiday_calendar(d, margin=0).collect()}
    assert (dt.date(1998, 11, 26), "Thanksgiving") in cal
    assert (dt.date(1998, 5, 25), "Memorial Day") in cal
    assert (dt.date(1998, 1, 19), "Martin Luther King Jr. Day") in cal
    assert (dt.date(2022, 6, 19), "Juneteenth") in cal
    assert not any(n == "Juneteenth" and x.year == 1998 for x, n in cal)


def test_asof_distance_brute_force(spark):
    cal = [dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 2, 19)]
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    c = spark.createDataFrame([(d,) for d in cal], "date date")
    got = {r.date: (r.days_since_prev, r.days_until_next) for r in J.asof_distance(df, "date", c).collect()}
    for d in days:
        prev = [x for x in cal if x < d]
        nxt = [x for x in cal if x >= d]
        want = ((d - max(prev)).days if prev else None, (min(nxt) - d).days if nxt else None)
        assert got[d] == want


def test_rolling_mean_brute_force_many_partitions(spark):
    import random

    rnd = random.Random(3)
    data = [(i // 7, i, float(rnd.randrange(100)), "s%d" % (i % 3)) for i in range(400)]
    df = spark.createDataFrame(data, "d int, k int, v double, s string")
    got = ST.rolling_mean(df, ["d", "k"], ["v"], rows=5, partitions=13).toPandas().sort_values("k")
    want = pd.DataFrame(data, columns=["d", "k", "v", "s"]).sort_values(["d", "k"])
    want["r"] = want["v"].rolling(5, min_periods=1).mean()
    assert (abs(got["rolling_v"].values - want.sort_values("k")["r"].values) < 1e-9).all()
    # per series restart
    got_s = ST.rolling_mean(df, ["d", "k"], ["v"], rows=3, series="s", partitions=5).toPandas().sort_values("k")
    w = pd.DataFrame(data, columns=["d", "k", "v", "s"]).sort_values(["s", "d", "k"])
    w["r"] = w.groupby("s")["v"].transform(lambda x: x.rolling(3, min_periods=1).mean())
    assert (abs(got_s["rolling_v"].values - w.sort_values("k")["r"].values) < 1e-9).all()


def test_velocity_members_match_counts(spark):
    from quarry.sources.fixtures import transactions_from_events

    tx = transactions_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    alerts = FR.velocity_alerts(tx, "24 hours", "12 hours", 5)
    members = FR.velocity_members(tx, alerts, "24 hours", "12 hours")
    per = members.groupBy("customer_id", "window_start").count()
    joined = alerts.join(per, ["customer_id", "window_start"])
    assert joined.filter(F.col("count") != F.col("transaction_count")).count() == 0
    assert joined.count() == alerts.count()


def test_hot_customer_interval_join_and_velocity(spark):
    """One customer holds a third of the rows; results equal brute force."""
    import random

    rnd = random.Random(11)
    data = []
    start = dt.datetime(2024, 1, 1)
    for i in range(1500):
        hot = i % 3 == 0
        cust = "hot" if hot else f"c{i % 40}"
        ts = start + dt.timedelta(seconds=rnd.randrange(0, 3600 * 6 if hot else 86400 * 3))
        data.append((str(i), ts.isoformat(sep=" "), cust, 100, "approved", rnd.random(), rnd.random()))
    df = tx_rows(spark, data)
    got = sorted(map(tuple, FR.geo_alerts(df, threshold=0.9).select("tx_id_1", "tx_id_2").collect()))
    pdf = df.toPandas()
    want = []
    for _, g in pdf.groupby("customer_id"):
        g = g.sort_values("event_time").reset_index(drop=True)
        t = g["event_time"].values
        for a in range(len(g)):
            b = a + 1
            while b < len(g) and t[b] <= t[a] + pd.Timedelta(minutes=5).to_timedelta64():
                if t[b] > t[a]:
                    d = math.hypot(g.location_lat[a] - g.location_lat[b], g.location_lng[a] - g.location_lng[b])
                    if d > 0.9:
                        want.append((g.transaction_id[a], g.transaction_id[b]))
                b += 1
    assert got == sorted(want)
    alerts = FR.velocity_alerts(df, "1 hour", "30 minutes", 50)
    members = FR.velocity_members(df, alerts, "1 hour", "30 minutes")
    assert members.count() == alerts.agg(F.sum("transaction_count")).first()[0]


def test_golden_anchors(spark):
    """Arithmetic anchors of the reference's committed outputs: the commission
    ratio is 0.02 / 1.09 in every group, counts by group add up to the row
    count, and the approval rate is approved / (approved + declined) * 100."""
    from quarry.sources.fixtures import transactions

    tx = transactions(spark, "/root/testdata/sf0.01")
    n = tx.count()
    cat = R.merchant_category_summary(tx).collect()
    assert all(abs(r.commission_to_transaction_ratio - 0.02 / 1.09) < 1e-12 for r in cat)
    assert sum(r.total_successful_txns + r.total_failed_txns for r in cat) == n
    assert sum(r.total_count for r in R.customer_type_summary(tx).collect()) == n
    assert sum(r.total_transactions for r in R.daily_summary(tx).collect()) == n
    for r in R.status_by_hour(tx).collect():
        assert abs(r.approval_rate - r.approved / (r.approved + r.declined) * 100) < 1e-12


def test_tails_hold_for_any_degrees_of_freedom():
    # two-sided 5 % points; the normal limit; the closed forms at 1 and 2 degrees of freedom
    for t, dof in ((12.706204736, 1), (4.302652730, 2), (3.182446305, 3), (2.228138852, 10), (1.983971519, 100)):
        assert abs(tails.t_two_sided(t, dof) - 0.05) < 1e-8
    assert abs(tails.t_two_sided(2.0, 1e12) - tails.normal_two_sided(2.0)) < 1e-9
    assert abs(tails.t_two_sided(3.0, 2) - (1 - 3 / math.sqrt(2 + 9))) < 1e-12
    assert tails.t_two_sided(float("inf"), 5) == 0.0 and math.isnan(tails.t_two_sided(1.0, 0.0))


def test_statistics_without_rows_spread_or_weight_are_null(spark):
    one = spark.createDataFrame([(1, 4.0), (0, 4.0), (0, 4.0)], "grp int, v double")
    r = ST.welch(one, "grp", ["v"], 1, 0).first()
    assert r.t_stat is None and r.dof is None
    empty = spark.createDataFrame([("a", None), ("b", 1.0)], "grp string, x double")
    assert {r.grp: r.lower for r in ST.proportion_intervals(empty, "grp", "x").collect()}["a"] is None
    polls = spark.createDataFrame([(0, 40.0, 60.0)], "n long, a double, b double")
    assert ST.spread(polls, "n", "a", "b").first().z is None
    from quarry.operators import learn as L

    rows_ = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 1.0), ("b", 3.0, 3.0)], "g string, x double, y double")
    got = {r.g: r.mse for r in L.group_line_mse(rows_, ["g"], "x", "y").collect()}
    assert got == {"b": 1.0, "all": 1.0}  # one row: left out; constant x: the mean


def test_large_values_keep_their_figures(spark):
    df = spark.createDataFrame([("g", float(i) * 1e7) for i in range(100)], "g string, x double")
    assert all(r.density > 0 for r in ST.density_histogram(df, "x", 5).collect())
    assert ST.density_histogram(df.filter("x < 0"), "x", 5).count() == 0
    assert ST.density_histogram(df.limit(1), "x", 3).agg(F.sum("count")).first()[0] == 1


def test_rolling_mean_with_a_null_series(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(6)] + [(None, i, 1.0) for i in range(6)], "s string, k int, v double")
    got = ST.rolling_mean(df, ["k"], ["v"], rows=2, series="s", partitions=3).toPandas()
    assert len(got) == 12 and (got[got.s.isna()].rolling_v == 1.0).all()


def test_observed_holidays(spark):
    d = spark.createDataFrame([(dt.date(2021, 6, 1),), (dt.date(2023, 6, 1),)], "date date")
    cal = {r.date: r.name for r in holiday_calendar(d, margin=0).collect()}
    assert cal[dt.date(2021, 7, 5)] == "Independence Day (observed)"    # the 4th was a Sunday
    assert cal[dt.date(2021, 6, 18)] == "Juneteenth (observed)"         # the 19th was a Saturday
    assert cal[dt.date(2021, 12, 24)] == "Christmas Day (observed)"
    assert cal[dt.date(2021, 12, 31)] == "New Year's Day (observed)"    # of 2022, a Saturday
    assert cal[dt.date(2023, 1, 2)] == "New Year's Day (observed)"


def test_payment_preference_has_zero_cells(spark):
    df = tx_rows(spark, [("1", "2024-01-01 00:00:00", "c", 100, "approved", 0.0, 0.0)])
    got = {r.payment_method: (r.n, r.share, r.is_top_method) for r in R.payment_preference(df).collect()}
    assert got == {"pos": (1, 1.0, True), "online": (0, 0.0, False), "mobile": (0, 0.0, False), "nfc": (0, 0.0, False)}


def test_velocity_records_split_many_ids(spark, monkeypatch):
    monkeypatch.setattr(FR, "IDS_PER_ALERT", 10)
    df = tx_rows(spark, [(str(i), "2024-01-01 00:00:%02d" % (i % 60), "c", 100, "approved", 0.0, 0.0) for i in range(200)])
    alerts = FR.velocity_alerts(df)
    got = FR.velocity_records(alerts, FR.velocity_members(df, alerts)).filter("window_start = '2024-01-01 00:00:00'").collect()
    assert sorted(i for r in got for i in r.transaction_ids) == sorted(str(i) for i in range(200))
    assert len(got) > 5 and max(len(r.transaction_ids) for r in got) < 40


def test_checkpoint_folder_is_mandatory_on_a_cluster(spark, monkeypatch):
    from quarry import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_khop_through_a_hub_to_depth_fourteen(spark):
    # everybody trusts the hub, the hub starts a chain of twenty users
    edges = [(u, 1000) for u in range(60)] + [(1000, 2000)] + [(2000 + i, 2001 + i) for i in range(20)]
    e = spark.createDataFrame(edges, "trustor long, trustee long")
    reach = G.khop_reach(e, spark.createDataFrame([(u,) for u in range(60)], "user_id long"), max_depth=14)
    assert reach.filter("dst = 1000 AND hops = 1").count() == 60
    assert reach.filter("dst = 2012 AND hops = 14").count() == 60 and reach.filter("dst > 2012").count() == 0
    ratings = spark.createDataFrame([(u, 1, 3.0) for u in range(60)] + [(1000, 1, 1e9 + 1), (2000, 1, 1e9 + 3)], "user_id long, item_id int, label double")
    rows_ = ratings.filter("user_id < 60")
    got = G.khop_rating_stats(rows_, ratings, reach, range(1, 3)).filter("user_id = 7").first()
    assert (got.trust_count1, got.trust_mean1, got.trust_count2, got.trust_mean2, got.trust_std2) == (1, 1e9 + 1, 2, 1e9 + 2, 1.0)
