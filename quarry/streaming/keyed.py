"""A keyed store on plain Parquet: hash buckets, a versioned manifest, compaction, Bloom filters.

``upsert`` adds one entry per epoch: the rows, partitioned by the hash bucket of
their key, one folder per bucket touched. ``compact`` merges the entries of
each bucket into one, reading and rewriting only buckets that have something
to merge. Both write new folders first and end by putting a new manifest file
(``manifest-<version>.json``, renamed into place); readers take the highest
version, so a job that dies at any point leaves the last state standing, and
its folders are removed by a later compaction. Per key the row of the newest
epoch counts, whatever order entries are written or merged in; an epoch that
is written again before it is merged replaces its own entry.

The driver holds the manifest only: entries x buckets short strings. With
``bloom`` every bucket folder has a Bloom filter beside it, stored as rows
(word number, 64-bit mask); ``known`` probes the filters of a batch's own
buckets and reads the keys of those that may hold one.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import remove_path

PROBES = 4
BITS_PER_KEY = 10


class KeyedStore:
    """Rows of any columns, one per ``key``. ``buckets`` is fixed when the store is made."""

    def __init__(self, path: str, key: list[str], buckets: int = 64, bloom: bool = False):
        self.path, self.key, self.buckets, self.bloom = path.rstrip("/"), key, buckets, bloom
        #: (buckets probed, buckets whose keys were read) of the last ``known``
        self.last_probe = (0, 0)

    # --- manifest ---------------------------------------------------------------

    def _fs(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, spark: SparkSession) -> list[int]:
        path, fs = self._fs(spark)
        if not fs.exists(path(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path))]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _load(self, spark: SparkSession, version: int) -> dict:
        text = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils
        path, fs = self._fs(spark)
        where = path(f"{self.path}/manifest-{version:08d}.json")
        stream = fs.open(where)
        try:
            raw = bytes(text.readFullyToByteArray(stream))
        finally:
            stream.close()
        return json.loads(raw.decode())

    def manifest(self, spark: SparkSession) -> dict:
        versions = self._versions(spark)
        if not versions:
            return {"version": 0, "columns": None, "entries": {}, "merged": [], "note": None}
        return self._load(spark, versions[-1])

    def _swap(self, spark: SparkSession, state: dict) -> None:
        state = {**state, "version": state["version"] + 1}
        path, fs = self._fs(spark)
        draft = path(f"{self.path}/_draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if not fs.rename(draft, path(f"{self.path}/manifest-{state['version']:08d}.json")):
            raise RuntimeError(f"another writer has put version {state['version']} of {self.path}")

    # --- writing ----------------------------------------------------------------

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str) -> dict:
        """Writes ``rows`` (with ``epoch``) in bucket folders; the entry that describes them."""
        spark = rows.sparkSession
        folder = f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"
        rows.withColumn("__b", self._bucket()).repartition("__b").write.partitionBy("__b").parquet(folder)
        path, fs = self._fs(spark)
        found = sorted(int(s.getPath().getName()[4:]) for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("__b="))
        if self.bloom and found:
            written = spark.read.parquet(folder).select("__b", *self.key)
            sizes = written.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
            bits = F.greatest(F.lit(64), F.col("__n") * BITS_PER_KEY)
            at = written.join(sizes, "__b").select("__b", bits.alias("bits"), F.explode(F.array(*self._hashes())).alias("h")).withColumn("at", F.pmod("h", "bits"))
            words = at.groupBy("__b", "bits", F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("mask"))
            words.repartition("__b").write.partitionBy("__b").parquet(f"{folder}.bloom")
        return {"folder": folder, "buckets": found}

    def _hashes(self):
        return [F.xxhash64(*self.key, F.lit(i)) for i in range(PROBES)]

    def upsert(self, rows: DataFrame, epoch: int, compact_after: int | None = None) -> None:
        """The rows of one epoch; of equal keys within it one counts (the greatest row, so that reruns agree)."""
        spark = rows.sparkSession
        one = F.max(F.struct(*[c for c in rows.columns if c not in self.key] or [F.lit(0)])).alias("__r")
        single = rows.groupBy(*self.key).agg(one).select(*[c if c in self.key else F.col("__r")[c].alias(c) for c in rows.columns])
        entry = self._write(single.withColumn("epoch", F.lit(int(epoch)).cast("long")), "entry")
        state = self.manifest(spark)
        columns = single.withColumn("epoch", F.lit(0).cast("long")).schema.jsonValue()
        self._swap(spark, {**state, "columns": state["columns"] or columns, "entries": {**state["entries"], str(int(epoch)): entry}})
        if compact_after and len(state["entries"]) + 1 >= compact_after:
            self.compact(spark)

    def compact(self, spark: SparkSession, transform=None, note=None) -> int:
        """Merges the entries into the merged folders; returns the number of bucket folders read.

        ``transform(rows)`` may fold the merged rows (all buckets are rewritten then); ``note`` is kept in the manifest.
        """
        state = self.manifest(spark)
        if not state["entries"] and transform is None:
            return 0
        touched = {b for e in state["entries"].values() for b in e["buckets"]}
        old = [e for e in state["merged"]]
        if transform is not None:
            touched |= {b for e in old for b in e["buckets"]}
        read = 0
        stay = []
        folders = [(e["folder"], b) for e in state["entries"].values() for b in e["buckets"]]
        for e in old:
            folders += [(e["folder"], b) for b in e["buckets"] if b in touched]
            left = [b for b in e["buckets"] if b not in touched]
            if left:
                stay.append({**e, "buckets": left})
        read = len(folders)
        merged = stay
        if folders:
            rows = self._newest(self._read(spark, state, folders))
            rows = transform(rows) if transform is not None else rows
            merged = [*stay, self._write(rows, "merged")]
        self._swap(spark, {**state, "entries": {}, "merged": merged, "note": note if note is not None else state["note"]})
        self._clean(spark)
        return read

    def _clean(self, spark: SparkSession) -> None:
        """Removes folders that neither of the last two manifests names, and older manifests."""
        versions = self._versions(spark)
        named = set()
        for v in versions[-2:]:
            s = self._load(spark, v)
            named |= {e["folder"].rsplit("/", 1)[-1] for e in (*s["entries"].values(), *s["merged"])}
        path, fs = self._fs(spark)
        for status in fs.listStatus(path(self.path)):
            name = status.getPath().getName()
            if name.startswith(("entry-", "merged-", "_draft-")) and name.removesuffix(".bloom") not in named:
                remove_path(spark, f"{self.path}/{name}")
        for v in versions[:-2]:
            remove_path(spark, f"{self.path}/manifest-{v:08d}.json")

    # --- reading ----------------------------------------------------------------

    def _read(self, spark: SparkSession, state: dict, folders: list[tuple[str, int]]) -> DataFrame:
        schema = StructType.fromJson(state["columns"])
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{f}/__b={b}" for f, b in folders])

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key: at most one per entry and one merged are compared."""
        w = Window.partitionBy(*self.key).orderBy(F.col("epoch").desc())
        return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")

    def _folders(self, state: dict, buckets: set[int] | None = None) -> list[tuple[str, int]]:
        every = [*state["merged"], *state["entries"].values()]
        return [(e["folder"], b) for e in every for b in e["buckets"] if buckets is None or b in buckets]

    def exists(self, spark: SparkSession) -> bool:
        return bool(self._versions(spark))

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, with ``epoch``."""
        state = self.manifest(spark)
        return self._newest(self._read(spark, state, self._folders(state)))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys``; only the buckets that those keys fall into are read."""
        spark = keys.sparkSession
        state = self.manifest(spark)
        asked = keys.select(*self.key).distinct()
        buckets = {r[0] for r in asked.select(self._bucket()).distinct().collect()}  # at most ``buckets``
        return self._newest(self._read(spark, state, self._folders(state, buckets)).join(asked, self.key, "left_semi"))

    def known(self, keys: DataFrame, but_epoch: int | None = None) -> DataFrame:
        """Distinct ``keys`` that the store holds from an epoch other than ``but_epoch``.

        Filters are probed for the buckets of ``keys``; key columns are read of
        the bucket folders where all probes of some key are set, and compared.
        """
        spark = keys.sparkSession
        state = self.manifest(spark)
        asked = keys.select(*self.key).distinct().withColumn("__b", self._bucket())
        buckets = {r[0] for r in asked.select("__b").distinct().collect()}
        folders = [(f, b) for f, b in self._folders(state, buckets)]
        if but_epoch is not None and str(int(but_epoch)) in state["entries"]:
            own = state["entries"][str(int(but_epoch))]["folder"]
            folders = [x for x in folders if x[0] != own]
        read = folders
        if self.bloom and folders:
            entries = sorted({f for f, _ in folders})
            parts = [spark.read.parquet(*[f"{e}.bloom/__b={b}" for f, b in folders if f == e]).withColumn("__e", F.lit(i)).withColumn("__in", F.regexp_extract(F.input_file_name(), "__b=([0-9]+)", 1).cast("int"))
                     for i, e in enumerate(entries)]
            filters = reduce(DataFrame.unionByName, parts)
            sizes = filters.groupBy("__e", "__in").agg(F.max("bits").alias("__bits"))
            probes = asked.join(sizes, asked["__b"] == sizes["__in"]).select(*self.key, "__e", "__b", "__bits", F.explode(F.array(*self._hashes())).alias("__h"))
            at = F.pmod("__h", "__bits")
            probes = probes.select(*self.key, F.col("__e").alias("__pe"), "__b", F.shiftright(at, 6).alias("__word"), F.expr("shiftleft(1L, CAST(pmod(__h, __bits) & 63 AS INT))").alias("__flag"))
            met = probes.join(filters, (F.col("__pe") == F.col("__e")) & (F.col("__b") == F.col("__in")) & (F.col("__word") == F.col("word")) & (F.col("mask").bitwiseAND(F.col("__flag")) != 0))
            hits = met.groupBy(*self.key, "__pe", "__b").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == PROBES)
            read = [(entries[r["__pe"]], r["__b"]) for r in hits.select("__pe", "__b").distinct().collect()]  # at most entries x buckets
        self.last_probe = (len(folders), len(read))
        there = self._read(spark, state, read)
        if but_epoch is not None:
            there = there.filter(F.col("epoch") != int(but_epoch))
        return there.select(*self.key).join(asked, self.key, "left_semi").distinct()

