"""Keyed store: newest row per key, replays around compaction, folders read, Bloom probes, crashes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import summary as SU
from quarry.streaming import keyed
from quarry.streaming.keyed import KeyedStore
from quarry.streaming.store import Archive, PartialStore

ROW = "k string, v long"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def held(store, spark):
    return {r["k"]: r["v"] for r in store.read(spark).collect()}


def test_newest_epoch_counts_in_any_order_of_merging(spark, tmp_path):
    s = KeyedStore(str(tmp_path / "s"), ["k"], buckets=4)
    s.upsert(batch(spark, ("a", 1), ("b", 1), ("c", 1)), 0)
    s.upsert(batch(spark, ("b", 2)), 1)
    assert held(s, spark) == {"a": 1, "b": 2, "c": 1}
    s.compact(spark)
    assert held(s, spark) == {"a": 1, "b": 2, "c": 1}
    s.upsert(batch(spark, ("b", 1), ("a", 1)), 0)  # epoch 0 again, after epoch 1 was merged
    assert held(s, spark) == {"a": 1, "b": 2, "c": 1}
    s.upsert(batch(spark, ("c", 7), ("c", 9), ("d", 3)), 2)  # one of equal keys
    s.upsert(batch(spark, ("c", 8)), 2)  # the same epoch again replaces its entry
    assert held(s, spark) == {"a": 1, "b": 2, "c": 8}
    s.compact(spark)
    assert held(s, spark) == {"a": 1, "b": 2, "c": 8}


def test_compaction_reads_only_buckets_with_news_and_lookup_only_asked_ones(spark, tmp_path):
    s = KeyedStore(str(tmp_path / "s"), ["k"], buckets=16)
    s.upsert(spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")), 0)
    assert s.compact(spark) == 16
    assert s.compact(spark) == 0
    s.upsert(batch(spark, ("7", -1)), 1)
    assert s.compact(spark) == 2  # the bucket's news and its merged folder
    assert held(s, spark) == {str(i): (-1 if i == 7 else i) for i in range(400)}
    got = s.lookup(batch(spark, ("7", 0), ("9", 0), ("nobody", 0)))
    files = {f.rsplit("/", 2)[-2] for f in got.inputFiles()}
    assert {(r["k"], r["v"]) for r in got.collect()} == {("7", -1), ("9", 9)} and len(files) <= 3


def test_a_job_that_dies_leaves_the_last_state(spark, tmp_path, monkeypatch):
    s = KeyedStore(str(tmp_path / "s"), ["k"], buckets=4)
    s.upsert(batch(spark, ("a", 1)), 0)
    s.upsert(batch(spark, ("a", 2), ("b", 2)), 1)
    with monkeypatch.context() as m:
        m.setattr(KeyedStore, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            s.compact(spark)
        with pytest.raises(RuntimeError):
            s.upsert(batch(spark, ("z", 9)), 2)
    assert held(s, spark) == {"a": 2, "b": 2}
    s.compact(spark)
    s.upsert(batch(spark, ("c", 3)), 3)
    s.compact(spark)
    assert held(s, spark) == {"a": 2, "b": 2, "c": 3}
    assert len([n for n in os.listdir(tmp_path / "s") if n.startswith(("entry-", "merged-"))]) <= 4  # left-overs are gone


def minute(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)


def partials(spark, *rows):
    cols = list(SU.PARTY.sums)
    return spark.createDataFrame([(k, minute(w), *[n * (i + 1) for i in range(len(cols))]) for k, w, n in rows], "merchant_id string, window_start timestamp, " + ", ".join(f"{c} long" for c in cols))


def test_replays_before_during_and_after_compaction(spark, tmp_path, monkeypatch):
    epochs = [partials(spark, ("m1", 0, 1), ("m2", 0, 2)), partials(spark, ("m1", 1, 3)), partials(spark, ("m1", 2, 4), ("m3", 2, 5)), partials(spark, ("m2", 3, 6))]
    want = None
    for replay_at in ("never", "before", "during", "after", "folded"):
        s = PartialStore(str(tmp_path / replay_at), "merchant_id", SU.PARTY, buckets=4, compact_after=None)
        for e, p in enumerate(epochs):
            s.write(p, e)
        if replay_at == "before":
            s.write(epochs[1], 1)
        if replay_at == "during":  # the merge dies after writing, epoch 2 comes again, the merge is repeated
            with monkeypatch.context() as m:
                m.setattr(KeyedStore, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
                with pytest.raises(RuntimeError):
                    s.compact(spark)
            s.write(epochs[2], 2)
        s.compact(spark)
        if replay_at in ("after", "folded"):
            if replay_at == "folded":
                s.fold(spark, str(minute(2)))
                assert s.latest(spark).filter("window_start IS NULL").count() == 2  # m1 and m2
            for e in (0, 3, 1):
                s.write(epochs[e], e)
            s.compact(spark)
        got = sorted(map(str, s.summary(spark).collect()))
        want = want or got
        assert got == want and len(got) == 3


def test_entries_are_merged_after_a_while(spark, tmp_path):
    s = PartialStore(str(tmp_path / "s"), "merchant_id", SU.PARTY, buckets=2, compact_after=3)
    for e in range(7):
        s.write(partials(spark, ("m1", e, 1)), e)
        assert len(s.rows.manifest(spark)["entries"]) < 3
    assert s.summary(spark).first()["total_trxs"] == 7


def keys(spark, lo, hi, day=1):
    return spark.range(lo, hi).select(F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit(dt.datetime(2024, 1, day)).alias("event_time"))


def test_archive_reads_few_keys_and_stays_exact_with_false_positives(spark, tmp_path, monkeypatch):
    a = Archive(str(tmp_path / "fine"), "transaction_id", buckets=32, compact_after=3)
    a.write(keys(spark, 0, 3000), 0)
    a.write(keys(spark, 3000, 3040), 1)  # new keys only
    probed, read = a.keys.last_probe
    assert 10 < probed <= 32 and read <= 4
    a.write(keys(spark, 2999, 3050, 9), 2)  # 41 old keys in two entries, 10 new ones
    probed, read = a.keys.last_probe
    assert read < probed
    a.write(keys(spark, 0, 4), 3)
    assert a.keys.last_probe[1] <= 8
    assert a.read(spark).count() == a.read(spark).select("transaction_id").distinct().count() == 3050
    monkeypatch.setattr(keyed, "BITS_PER_KEY", 1)  # filters that say yes nearly always
    b = Archive(str(tmp_path / "coarse"), "transaction_id", buckets=4, compact_after=3)
    b.write(keys(spark, 0, 3000), 0)
    b.write(keys(spark, 2990, 3040), 1)
    assert b.keys.last_probe == (4, 4)
    b.write(keys(spark, 2990, 3041), 1)  # a replay with one more
    assert b.read(spark).count() == b.read(spark).select("transaction_id").distinct().count() == 3041


def test_archive_from_before_there_were_keys(spark, tmp_path):
    from quarry.streaming.store import write_epoch

    path = str(tmp_path / "old")
    write_epoch(keys(spark, 0, 10).withColumn("date", F.to_date("event_time")), path, 0, "date")
    write_epoch(keys(spark, 10, 20).withColumn("date", F.to_date("event_time")), path, 1, "date")
    a = Archive(path, "transaction_id")
    a.write(keys(spark, 5, 25), 1)  # epoch 1 again, with more rows
    assert a.read(spark).count() == a.read(spark).select("transaction_id").distinct().count() == 25
