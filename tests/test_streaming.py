"""Stream = batch on closed windows, lateness, restart and replay."""

import os

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarry.operators import reports as R
from quarry.operators import summary as SU
from quarry.sources.fixtures import transactions_from_events
from quarry.sources.streams import event_file_stream
from quarry.streaming import jobs as J
from quarry.streaming import runner
from quarry.streaming.store import Archive, PartialStore
from tests.conftest import SF_SMALL
from tests.helpers import rows


def _write_days(directory, days, name_offset=0):
    """One parquet file per calendar day of the sf0.001 events."""
    table = pq.read_table(f"{SF_SMALL}/events.parquet")
    day = pc.cast(pc.cast(table["ts"], "date32"), "string")
    os.makedirs(directory, exist_ok=True)
    for i, d in enumerate(days):
        part = table.filter(pc.equal(day, d))
        path = os.path.join(directory, f"{name_offset + i:04d}.parquet")
        pq.write_table(part, path + ".tmp")
        # the file source orders files by modification time alone: let it rise with the days
        os.utime(path + ".tmp", times=(1_700_000_000 + 10 * (name_offset + i),) * 2)
        os.rename(path + ".tmp", path)


def _all_days():
    return [f"2024-01-{d:02d}" for d in range(1, 31)]


def _batch_closed_customer_type(spark, upto_days, delay_s=20):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    tx = transactions_from_events(ev).filter(F.to_date("event_time").isin(upto_days))
    mx = tx.agg(F.max("event_time")).first()[0]
    import datetime as dt

    wm = mx - dt.timedelta(seconds=delay_s)
    minute = F.date_trunc("minute", "event_time")
    closed = tx.filter(minute + F.expr("INTERVAL 1 MINUTE") <= F.lit(wm))
    return closed.groupBy("customer_type").agg(*[a().alias(n) for n, a in SU.CATEGORY.sums.items()])


def _fold(df):
    return SU.read_summary(df.withColumn("window_start", F.lit(0)), "customer_type", SU.CATEGORY)


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:6])
    stream = event_file_stream(spark, src, max_files_per_trigger=1)
    store = PartialStore(str(tmp_path / "store"), "customer_type", SU.CATEGORY)
    runner.run_foreach(spark, J.summary_partials(stream, "customer_type", SU.CATEGORY), "t1", store.write)
    got = store.summary(spark).toPandas()
    want = _fold(_batch_closed_customer_type(spark, _all_days()[:6])).toPandas()
    assert rows(got) == rows(want)


def test_restart_from_checkpoint_does_not_double_count(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    store = PartialStore(str(tmp_path / "store"), "customer_type", SU.CATEGORY)
    _write_days(src, _all_days()[:3])
    q = runner.start(J.summary_partials(event_file_stream(spark, src, max_files_per_trigger=1),
                                        "customer_type", SU.CATEGORY), ckpt, "append", store.write)
    q.awaitTermination()
    _write_days(src, _all_days()[3:6], name_offset=3)
    q = runner.start(J.summary_partials(event_file_stream(spark, src, max_files_per_trigger=1),
                                        "customer_type", SU.CATEGORY), ckpt, "append", store.write)
    q.awaitTermination()
    got = store.summary(spark).toPandas()
    want = _fold(_batch_closed_customer_type(spark, _all_days()[:6])).toPandas()
    assert rows(got) == rows(want)


def test_late_file_adds_nothing(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    out = PartialStore(str(tmp_path / "store"), "customer_type", SU.CATEGORY)
    _write_days(src, _all_days()[4:8])
    build = lambda: J.summary_partials(event_file_stream(spark, src), "customer_type", SU.CATEGORY)
    runner.start(build(), ckpt, "append", out.write).awaitTermination()
    before = out.summary(spark).toPandas()
    # A day older than the watermark arrives later: every row is dropped.
    _write_days(src, ["2024-01-02"], name_offset=100)
    runner.start(build(), ckpt, "append", out.write).awaitTermination()
    after = out.summary(spark).toPandas()
    assert rows(before) == rows(after)


def test_replayed_epoch_is_idempotent(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    parts = SU.partials(transactions_from_events(ev), "customer_type", SU.CATEGORY)
    store = PartialStore(str(tmp_path / "store"), "customer_type", SU.CATEGORY)
    store.write(parts, 0)
    once = store.summary(spark).toPandas()
    store.write(parts, 0)  # the same epoch again after a failure
    store.write(parts, 1)  # and the same partials re-emitted by a later epoch
    assert rows(store.summary(spark).toPandas()) == rows(once)
    want = R.customer_type_summary(transactions_from_events(ev)).toPandas()
    assert rows(once) == rows(want)


@pytest.mark.parametrize("cut", ["2024-01-05", "2024-01-17", "2024-01-29"])
def test_merge_law(spark, cut):
    tx = transactions_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    a = SU.partials(tx.filter(F.col("event_time") < F.lit(cut).cast("timestamp")), "merchant_id", SU.PARTY)
    b = SU.partials(tx.filter(F.col("event_time") >= F.lit(cut).cast("timestamp")), "merchant_id", SU.PARTY)
    ab = SU.merge_summary(a, b, "merchant_id", SU.PARTY).toPandas()
    ba = SU.merge_summary(b, a, "merchant_id", SU.PARTY).toPandas()
    full = R.merchant_summary(tx).toPandas()
    assert rows(ab) == rows(full) == rows(ba)


def test_archive_insert_if_absent_across_epochs(spark, tmp_path):
    tx = transactions_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).select(
        "transaction_id", "customer_id", "total_amount", "event_time")
    arch = Archive(str(tmp_path / "archive"), "transaction_id")
    first = tx.filter(F.col("transaction_id").cast("int") < 600)
    arch.write(first, 0)
    arch.write(tx, 1)          # overlaps the first batch
    arch.write(tx, 1)          # replay of epoch 1
    got = arch.read(spark)
    assert got.count() == tx.count()
    assert got.select("transaction_id").distinct().count() == tx.count()


def test_archive_takes_a_key_once_whatever_its_time(spark, tmp_path):
    import datetime as dt

    def batch(*rows):
        return spark.createDataFrame([(k, dt.datetime(2024, 1, d)) for k, d in rows], "transaction_id string, event_time timestamp")

    arch = Archive(str(tmp_path / "archive"), "transaction_id")
    arch.write(batch(("t1", 1)), 0)
    arch.write(batch(("t1", 5), ("t2", 5)), 1)
    assert sorted(r.transaction_id for r in arch.read(spark).collect()) == ["t1", "t2"]
    # a replayed epoch with one more row keeps all of its rows
    arch.write(batch(("t1", 5), ("t2", 5), ("t3", 5)), 1)
    assert sorted(r.transaction_id for r in arch.read(spark).collect()) == ["t1", "t2", "t3"]


def test_stores_are_empty_before_the_first_window_closes(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    parts = SU.partials(transactions_from_events(ev), "customer_type", SU.CATEGORY).withColumn("window_start", F.lit(0))
    store = PartialStore(str(tmp_path / "store"), "customer_type", SU.CATEGORY)
    store.write(parts.filter("false"), 0)
    assert store.summary(spark).count() == 0


def test_amount_rule_reads_a_rewritten_summary(spark, tmp_path):
    from quarry.streaming.store import read_epochs

    src, path, out = str(tmp_path / "src"), str(tmp_path / "avg"), str(tmp_path / "out")
    _write_days(src, _all_days()[:1])
    tx = transactions_from_events(spark.read.parquet(src))
    averages = R.customer_summary(tx).select("customer_id", "avg_trx_value")
    averages.withColumn("avg_trx_value", F.lit(1e18)).write.parquet(path)
    sink = J.amount_sink(lambda: spark.read.parquet(path), out, factor=1)
    sink(tx, 0)
    assert read_epochs(spark, out).count() == 0
    averages.withColumn("avg_trx_value", F.lit(0.0)).write.mode("overwrite").parquet(path)
    sink(tx, 1)
    assert read_epochs(spark, out).count() == tx.filter("total_amount > 0").count()


def test_several_queries_in_one_session(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:2])
    s = event_file_stream(spark, src)
    q1 = runner.start(J.commission_by_type(s), str(tmp_path / "c1"), "append", "parquet", str(tmp_path / "o1"))
    q2 = runner.start(J.commission_ratio(s), str(tmp_path / "c2"), "append", "parquet", str(tmp_path / "o2"))
    assert runner.await_any(spark, 120)
    q1.awaitTermination()
    q2.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o1")).count() > 0


def test_top_per_window_stream_and_global_limit(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:2])
    top = J.top_merchants_global(J.merchant_commission(event_file_stream(spark, src)))
    got = runner.run_to_table(spark, top, "topk-test", mode="complete").toPandas()
    assert len(got) == 10
    # the limit is over (window end desc, commission desc): the last window first
    assert got["window_end"].max() == got.sort_values("window_end").iloc[-1]["window_end"]


def test_start_all_queries_in_one_session(spark, tmp_path):
    from quarry.streaming.service import start_all

    src = str(tmp_path / "src")
    _write_days(src, _all_days()[:3])
    tx = event_file_stream(spark, src)
    avgs = R.customer_summary(transactions_from_events(spark.read.parquet(src))).select("customer_id", "avg_trx_value")
    qs = start_all(spark, tx, str(tmp_path / "out"), avgs, fast={"availableNow": True}, slow={"availableNow": True},
                   velocity={"window": "24 hours", "slide": "12 hours", "limit": 5}, amount_factor=3)
    assert len(qs) == 12
    for q in qs.values():
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "commission_by_type")).count() > 0
    assert spark.read.parquet(str(tmp_path / "out" / "archive")).count() == spark.read.parquet(src).count()
    store = PartialStore(str(tmp_path / "out" / "customer_type_summary"), "customer_type", SU.CATEGORY)
    assert store.summary(spark).count() == 3
