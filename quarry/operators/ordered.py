"""Work on a total order without one task for it: dense positions, halos and carried values.

Rows are range partitioned and sorted once and written; a row's position is its
place in its partition plus the rows of the partitions before it. The offsets
come from the counts per partition, summed in two levels (about the square
root of the number of partitions each), so no step sees all rows, all
partitions or one whole key. A key with most of the rows is spread over as many
partitions as its rows need, because the order continues within the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import written


def numbered(df: DataFrame, keys: list, tag: str = "ordered", partitions: int | None = None, out: str = "__g") -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... in the order of ``keys`` (columns or names). Rows equal in all keys are told apart
    by their place in the input, so that even one value repeated without end is spread."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, F.col("__tie").asc()]
    placed = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("__tie")
    at = F.monotonically_increasing_id()
    rows, _ = written(placed.withColumn("__at", at), tag)
    part = F.shiftright("__at", 33)
    rows = rows.withColumns({"__part": part, "__at": F.col("__at") - F.shiftleft(part, 33)})
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    width = max(1, int(n**0.5))
    groups = counts.withColumn("__chunk", F.floor(F.col("__part") / width))
    # a partition's rows count for every later partition of its chunk, a chunk's rows for every later chunk
    inside = groups.select("__part", "__n", F.explode(F.sequence(F.col("__part"), (F.col("__chunk") + 1) * width - 1)).alias("__to"))
    across = groups.groupBy("__chunk").agg(F.sum("__n").alias("__n")).select("__chunk", "__n", F.explode(F.sequence(F.col("__chunk"), F.lit(n // width).cast("long"))).alias("__later"))
    inside = inside.groupBy("__to").agg(F.sum(F.when(F.col("__to") > F.col("__part"), F.col("__n")).otherwise(0)).alias("__inside"))
    across = across.groupBy("__later").agg(F.sum(F.when(F.col("__later") > F.col("__chunk"), F.col("__n")).otherwise(0)).alias("__across"))
    offsets = inside.join(across, F.floor(F.col("__to") / width) == F.col("__later")).select("__to", (F.col("__inside") + F.col("__across")).alias("__offset"))
    return rows.join(offsets, F.col("__part") == F.col("__to")).withColumn(out, F.col("__at") + F.col("__offset")).drop("__part", "__at", "__to", "__offset")


def asof_join(left: DataFrame, right: DataFrame, on: str, ts: str, take: list[str], tolerance: str | None = None, forward: bool = False, block: int = 1 << 16) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` with the same ``on`` and a ``ts`` not after the
    row's (``forward``: of the first not before it), and ``matched_ts``; NULL where there is none, or none within ``tolerance``.

    Both sides are put in one order by (on, ts) and cut into blocks of ``block``
    rows. Within a block a window carries the last right row; a block's last
    right row, if it belongs to the block's last key, is handed to the blocks
    after it (one row per block). So neither the calendar side nor a hot key is
    gathered in a task. Rows with a NULL ``on`` or ``ts`` match nothing; of
    right rows with the same key and time one counts, the greatest in ``take``.
    """
    spark_order = (lambda c: c.desc()) if forward else (lambda c: c.asc())
    known = F.col(on).isNotNull() & F.col(ts).isNotNull()
    hit = F.struct(F.col(ts).alias("ts"), *[F.col(c) for c in take])
    sides = right.filter(known).groupBy(on, ts).agg(F.max(F.struct(*take)).alias("__t")).select(on, ts, *[F.col("__t")[c].alias(c) for c in take])
    rights = sides.select(F.col(on).alias("__k"), F.col(ts).alias("__ts"), F.lit(0).alias("__side"), hit.alias("__hit"), F.lit(None).cast(left.schema).alias("__row"))
    lefts = left.filter(known).select(F.col(on).alias("__k"), F.col(ts).alias("__ts"), F.lit(1).alias("__side"), F.lit(None).cast(rights.schema["__hit"].dataType).alias("__hit"), F.struct(*left.columns).alias("__row"))
    rows = numbered(rights.unionByName(lefts), [F.col("__k").asc(), spark_order(F.col("__ts")), F.col("__side").asc()], "asof").withColumn("__b", F.floor(F.col("__g") / block))
    inside = F.last("__hit", ignorenulls=True).over(Window.partitionBy("__b", "__k").orderBy("__g").rowsBetween(Window.unboundedPreceding, 0))
    last = F.struct("__g", "__k", "__hit")
    ends = rows.groupBy("__b").agg(F.max(F.struct("__g", "__k")).alias("end"), F.max_by(last, F.when(F.col("__side") == 0, F.col("__g"))).alias("seen"))
    ends = ends.select((F.col("__b") + 1).alias("__cb"), F.col("end.__k").alias("__ck"), F.when(F.col("seen.__k") == F.col("end.__k"), F.col("seen.__hit")).alias("__carry"))
    carried = F.last("__carry", ignorenulls=True).over(Window.partitionBy("__ck").orderBy("__cb").rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("__carry", carried)
    found = rows.withColumn("__in", inside).filter("__side = 1")
    found = found.join(ends, (F.col("__b") == F.col("__cb")) & (F.col("__k") == F.col("__ck")), "left").withColumn("__m", F.coalesce("__in", "__carry"))
    if tolerance:
        far = (F.col("__m.ts") > F.col("__ts") + F.expr(f"INTERVAL {tolerance}")) if forward else (F.col("__m.ts") < F.col("__ts") - F.expr(f"INTERVAL {tolerance}"))
        found = found.withColumn("__m", F.when(~far, F.col("__m")))
    names = [*[F.col("__row")[c].alias(c) for c in left.columns], F.col("__m")["ts"].alias("matched_ts"), *[F.col("__m")[c].alias(f"matched_{c}") for c in take]]
    none = left.filter(~known)
    empty = [F.lit(None).cast(right.schema[c].dataType).alias(f"matched_{c}") for c in take]
    return found.select(*names).unionByName(none.select(*left.columns, F.lit(None).cast(right.schema[ts].dataType).alias("matched_ts"), *empty))


def rolling(df: DataFrame, keys: list[str], series: str | None, values: list[str], rows: int, partitions: int | None = None, block: int = 1 << 16) -> DataFrame:
    """``df`` with ``rolling_{v}``: mean of the row's and the ``rows`` - 1 values before it (of its series) in the order of ``keys``.

    Blocks of consecutive rows, each with the ``rows`` - 1 rows before it as a
    halo, then a window per (block, series): exact for every block, and a block
    has at most ``block`` + ``rows`` rows whatever the series. NULL and NaN count as missing.
    """
    block = max(block, rows)
    g = F.col("__g")
    inner = numbered(df, [F.col(k).asc() for k in keys], "rolling", partitions).withColumn("__own", F.floor(g / block))
    near_end = g % block > block - rows
    spread = inner.withColumn("__b", F.explode(F.when(near_end, F.array("__own", F.col("__own") + 1)).otherwise(F.array("__own"))))
    window = Window.partitionBy("__b", *([series] if series else [])).orderBy("__g").rowsBetween(-(rows - 1), 0)
    present = {v: F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")) for v in values}
    out = spread.withColumns({f"rolling_{v}": F.avg(c).over(window) for v, c in present.items()})
    return out.filter("__b = __own").drop("__g", "__own", "__b")


def group_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Per ``keys``: ``quantiles``, the exact quantiles of the non-NULL values (linear between neighbours; NaN is the greatest).

    The values are put in one order by (keys, value); a quantile is read at two
    positions counted from its key's first. No key's values are held together.
    """
    rows = numbered(df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v IS NOT NULL"), [*[F.col(k).asc() for k in keys], F.col("__v").asc()], "quantiles")
    starts = rows.groupBy(*keys).agg(F.min("__g").alias("__first"), F.count(F.lit(1)).alias("__count"))
    wanted = starts.select(*keys, "__first", "__count", F.posexplode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("__i", "__p"))
    at = F.col("__p") * (F.col("__count") - 1)
    ends = F.array(F.struct(F.floor(at).alias("at"), (1 - (at - F.floor(at))).alias("w")), F.struct(F.ceil(at).alias("at"), (at - F.floor(at)).alias("w")))
    asked = wanted.select(*keys, "__first", "__i", F.inline(ends)).withColumn("__want", F.col("__first") + F.col("at")).filter("w > 0")
    got = asked.join(rows.select(F.col("__g").alias("__want"), "__v"), "__want")
    one = got.groupBy(*keys, "__i").agg(F.sum(F.col("w") * F.col("__v")).alias("__q"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__q"))), lambda x: x["__q"])
    return one.groupBy(*keys).agg(listed.alias("quantiles"))
