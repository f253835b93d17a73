"""From raw messages to accepted rows, errors and alerts: run, stop, restart, die, replay."""

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import fraud as FR
from quarry.operators import ingest as I
from quarry.operators import reports as R
from quarry.operators import summary as SU
from quarry.sources.fixtures import raw_messages_from_transactions, transactions_from_events
from quarry.sources.streams import event_file_stream
from quarry.streaming.platform import Platform
from quarry.streaming.service import start_from_messages
from quarry.streaming.store import PartialStore
from tests.test_streaming import _all_days, _write_days

VELOCITY = {"window": "24 hours", "slide": "12 hours", "limit": 5}


def raw_stream(spark, src):
    return raw_messages_from_transactions(event_file_stream(spark, src, max_files_per_trigger=1))


def raw_table(spark, src):
    return raw_messages_from_transactions(transactions_from_events(spark.read.parquet(src)))


def expected(spark, src, averages):
    """(accepted ids, error keys, alerts) of one batch over everything; velocity windows that the watermark has passed."""
    ok, bad = I.split_valid(I.ingest(raw_table(spark, src)))
    ok = ok.select(*I.FLAT_COLUMNS)
    velocity = FR.velocity_alerts(ok, **VELOCITY)
    end = ok.agg(F.max(F.unix_micros("event_time"))).first()[0] - 120 * 10**6
    velocity = velocity.filter(F.unix_micros("window_end") <= end)
    records = FR.velocity_records(velocity, FR.velocity_members(ok, velocity, VELOCITY["window"], VELOCITY["slide"]))
    alerts = FR.alerts_union(FR.amount_anomaly(ok, averages, 2.0), records, FR.geo_alerts(ok, "6 hours", 0.1))
    ids = sorted(r[0] for r in ok.select("transaction_id").collect())
    return ids, sorted(r["key"] for r in I.to_error_log(bad).collect()), sorted(map(tuple, alerts.collect()))


def found(spark, p):
    return (sorted(r[0] for r in p.read(spark, "accepted").select("transaction_id").collect()), sorted(r["key"] for r in p.read(spark, "errors").collect()),
            sorted(tuple(r[c] for c in ("key", "fraud_type", "value")) for r in p.read(spark, "alerts").collect()))


@pytest.fixture
def averages(spark):
    tx = transactions_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    return R.customer_summary(tx).select("customer_id", "avg_trx_value")


def platform(tmp_path, averages):
    return Platform(str(tmp_path / "out"), lambda: averages, amount_factor=2.0, velocity=VELOCITY, within="6 hours", threshold=0.1)


def test_runs_stops_restarts_and_replays(spark, tmp_path, averages):
    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:3])
    p = platform(tmp_path, averages)
    p.start(raw_stream(spark, src)).awaitTermination()
    assert found(spark, p) == expected(spark, src, averages)
    _write_days(src, _all_days()[3:6], name_offset=3)
    p = platform(tmp_path, averages)  # another process
    p.start(raw_stream(spark, src)).awaitTermination()
    want = expected(spark, src, averages)
    assert found(spark, p) == want and all(want)
    assert len({a[1] for a in want[2]}) == 3
    members = [json.loads(a[2]) for a in want[2] if "transaction_ids" in a[2]]
    assert members and all(len(m["transaction_ids"]) == m["transaction_count"] for m in members)
    assert p.commits(spark) == list(range(6))
    # the last epoch comes again after its commit, and once more after dying before it
    last = raw_messages_from_transactions(transactions_from_events(spark.read.parquet(f"{src}/0005.parquet")))
    p.sink(last, 5)
    assert found(spark, p) == want


def test_an_epoch_that_dies_is_invisible_until_replayed(spark, tmp_path, averages, monkeypatch):
    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:2])
    p = platform(tmp_path, averages)
    first, second = (raw_messages_from_transactions(transactions_from_events(spark.read.parquet(f"{src}/{i:04d}.parquet"))) for i in range(2))
    p.sink(first, 0)
    before = found(spark, p)
    with monkeypatch.context() as m:
        m.setattr(Platform, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            p.sink(second, 1)
    assert found(spark, p) == before and p.commits(spark) == [0]
    p.sink(second, 1)
    assert found(spark, p) == expected(spark, src, averages)


def test_messages_that_are_all_broken_or_none(spark, tmp_path, averages):
    p = platform(tmp_path, averages)
    raw = spark.createDataFrame([("k", "not json", None), ("k", None, None)], "key string, value string, timestamp timestamp")
    p.sink(raw, 0)
    assert [r["key"] for r in p.read(spark, "errors").collect()] == ["UNKNOWN", "UNKNOWN"]
    p.sink(raw.limit(0), 1)
    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:1])
    p.sink(raw_table(spark, src), 2)
    assert p.read(spark, "accepted").count() == I.transactions_from_messages(raw_table(spark, src)).count() > 0


def test_messages_feed_all_twelve_queries(spark, tmp_path, averages):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    _write_days(src, _all_days()[:2])
    qs = start_from_messages(spark, raw_messages_from_transactions(event_file_stream(spark, src)), out, averages, fast={"availableNow": True}, slow={"availableNow": True},
                             velocity=VELOCITY, amount_factor=3)
    assert len(qs) == 12
    for q in qs.values():
        q.awaitTermination()
    accepted = I.transactions_from_messages(raw_table(spark, src))
    assert spark.read.parquet(f"{out}/archive").count() == accepted.count() < spark.read.parquet(src).count()
    assert PartialStore(f"{out}/merchant_summary", "merchant_id", SU.PARTY).summary(spark).count() > 0
