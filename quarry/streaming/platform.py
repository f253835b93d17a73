"""One path from the raw topic to stored transactions, error log and alerts.

``Platform`` is a ``foreachBatch`` sink over raw (key, value, timestamp)
messages. An epoch decodes and validates its messages once, writes the
accepted rows and the error records, derives the alerts from the accepted rows
of this and earlier epochs, writes them as (key, JSON) records, and ends with
one commit file that also carries the watermark. Everything is written under
``epoch=<id>``; readers see epochs up to the last commit, so an epoch that dies
half-way is invisible and is replaced in full when it is replayed.

Alerts need rows of earlier epochs: a sliding window is judged once, by the
epoch whose watermark passes its end (as in append mode), with the ids of its
members; a pair of transactions is judged by the epoch that brings the later
arrival. Only the dates those windows can reach are read. Late rows still count
in windows that are open.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.functions import vocab as V
from quarry.operators import fraud as FR
from quarry.operators import ingest as I
from quarry.operators.joins import _seconds
from quarry.session import path_exists, remove_path
from quarry.streaming.runner import start
from quarry.streaming.store import read_epochs, write_epoch

KEPT_COMMITS = 10


class Platform:
    """``averages()`` gives (customer_id, avg_trx_value) and is asked anew by every epoch."""

    def __init__(self, root: str, averages: Callable[[], DataFrame], delay: str = "2 minutes", amount_factor: float = V.AMOUNT_FACTOR,
                 velocity: dict | None = None, within: str = V.GEO_WINDOW, threshold: float = V.GEO_THRESHOLD, validate: dict | None = None):
        self.root, self.averages, self.delay, self.factor = root.rstrip("/"), averages, _seconds(delay), amount_factor
        self.velocity = {"window": "2 minutes", "slide": "1 minute", "limit": V.VELOCITY_LIMIT, **(velocity or {})}
        self.within, self.threshold, self.validate = within, threshold, validate or {}

    # --- commits ------------------------------------------------------------------

    def commits(self, spark: SparkSession) -> list[int]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{self.root}/commits")
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        return sorted(int(n[:-5]) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.endswith(".json") and not n.startswith("_"))

    def _state(self, spark: SparkSession, before: int) -> dict:
        done = [e for e in self.commits(spark) if e < before]
        if not done:
            return {"watermark": None}
        return json.loads("".join(r[0] for r in spark.read.text(f"{self.root}/commits/{done[-1]:012d}.json").collect()))

    def _commit(self, spark: SparkSession, epoch: int, state: dict) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        final = path(f"{self.root}/commits/{epoch:012d}.json")
        fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(final):  # a replay finds its commit in place
            draft = path(f"{self.root}/commits/_{uuid.uuid4().hex}")
            stream = fs.create(draft, False)
            stream.write(bytearray(json.dumps(state).encode()))
            stream.close()
            fs.rename(draft, final)
        for old in self.commits(spark)[:-KEPT_COMMITS]:
            remove_path(spark, f"{self.root}/commits/{old:012d}.json")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """Committed rows of ``accepted``, ``errors`` or ``alerts``."""
        rows = read_epochs(spark, f"{self.root}/{table}")
        done = self.commits(spark)
        return rows.filter(F.col("epoch") <= (done[-1] if done else -1)).drop("epoch", "date")

    # --- one epoch ----------------------------------------------------------------

    def sink(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        checked = I.ingest(batch, **self.validate).persist()
        ok, bad = I.split_valid(checked)
        write_epoch(ok.select(*I.FLAT_COLUMNS, F.to_date("event_time").alias("date")), f"{self.root}/accepted", epoch, "date")
        write_epoch(I.to_error_log(bad), f"{self.root}/errors", epoch)
        checked.unpersist()
        stored = read_epochs(spark, f"{self.root}/accepted")
        new = stored.filter(F.col("epoch") == epoch)
        lo, hi = new.agg(F.min(F.unix_micros("event_time")), F.max(F.unix_micros("event_time"))).first()
        passed = self._state(spark, epoch)["watermark"]
        mark = passed if hi is None else max(hi - self.delay * 1_000_000, passed if passed is not None else hi - self.delay * 1_000_000)
        if path_exists(spark, f"{self.root}/accepted"):
            write_epoch(self._alerts(stored.filter(F.col("epoch") < epoch), new, lo, hi, passed, mark), f"{self.root}/alerts", epoch)
        self._commit(spark, epoch, {"watermark": mark})

    def _alerts(self, old: DataFrame, new: DataFrame, lo, hi, passed, mark) -> DataFrame:
        amount = FR.amount_anomaly(new, self.averages(), self.factor)
        window, slide = self.velocity["window"], self.velocity["slide"]
        both = old.unionByName(new)
        open_rows = both if passed is None else self._since(both, passed - _seconds(window) * 1_000_000)
        due = F.lit(True) if passed is None else F.unix_micros("window_end") > passed
        due = due & (F.unix_micros("window_end") <= (mark if mark is not None else -(1 << 62)))
        velocity = FR.velocity_alerts(open_rows, **self.velocity).filter(due)
        records = FR.velocity_records(velocity, FR.velocity_members(open_rows, velocity, window, slide))
        reach = _seconds(self.within) * 1_000_000
        near = old.filter("false") if lo is None else self._since(old, lo - reach).filter(F.unix_micros("event_time") <= hi + reach)
        geo = FR.geo_alerts(new, self.within, self.threshold, near.unionByName(new)).unionByName(FR.geo_alerts(near, self.within, self.threshold, new))
        return FR.alerts_union(amount, records, geo)

    def _since(self, rows: DataFrame, micros: int) -> DataFrame:
        """Rows from a time on; whole dates before it are not read."""
        day = dt.datetime.fromtimestamp(micros / 1e6, dt.timezone.utc).date()
        return rows.filter((F.col("date") >= F.lit(day)) & (F.unix_micros("event_time") >= micros))

    def start(self, raw: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        """The query; it goes on where its checkpoint under ``root`` stopped."""
        return start(raw, f"{self.root}/_checkpoints/platform", "append", self.sink, trigger=trigger, name=None)
