"""Rating statistics and trust-graph features.

The reference runs one breadth-first search per rating row and per depth
(9 x rows traversals). Here one breadth-first search runs for all sources, 64
to a 64-bit mask; the neighbours' ratings are collapsed to counts per (row, hop,
rating value) and every depth's statistics come from one more aggregate with
``hops <= d`` conditions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage, remove_path, written


def item_rating_stats(ratings: DataFrame, item: str = "item_id", label: str = "label") -> DataFrame:
    """Per item mean, sample variance, count, min, max, median."""
    return ratings.groupBy(item).agg(
        F.avg(label).alias("average_rating"),
        F.var_samp(label).alias("variance_rating"),
        F.count(label).alias("number_of_reviews"),
        F.min(label).alias("min_rating"),
        F.max(label).alias("max_rating"),
        F.median(label).alias("median_rating"),
    )


def user_rating_stats(ratings: DataFrame, user: str = "user_id", label: str = "label") -> DataFrame:
    """Per user mean, sample variance, count, median."""
    return ratings.groupBy(user).agg(
        F.avg(label).alias("average_rating"),
        F.var_samp(label).alias("variance_rating"),
        F.count(label).alias("number_of_ratings"),
        F.median(label).alias("median_of_ratings"),
    )


def trust_degrees(edges: DataFrame, src: str = "trustor", dst: str = "trustee") -> DataFrame:
    """Out-degree (trustees) and in-degree (trusters) per user, 0 when absent."""
    out_deg = edges.groupBy(F.col(src).alias("user_id")).agg(F.count(F.lit(1)).alias("total_number_of_trustees"))
    in_deg = edges.groupBy(F.col(dst).alias("user_id")).agg(F.count(F.lit(1)).alias("total_number_of_trusters"))
    return out_deg.join(in_deg, "user_id", "full").na.fill(0, ["total_number_of_trustees", "total_number_of_trusters"])


def user_features(ratings: DataFrame, edges: DataFrame) -> DataFrame:
    """User rating statistics with degrees (missing degree -> 0)."""
    return (
        user_rating_stats(ratings)
        .join(trust_degrees(edges), "user_id", "left")
        .na.fill(0, ["total_number_of_trustees", "total_number_of_trusters"])
    )


def rating_baseline(train: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """G1: global mean, user and item bias (mean of label - global mean),
    baseline = mean + b_u + b_i and residual. ``rows`` defaults to ``train``;
    an unseen user or item has bias 0 (quirk Q15)."""
    rows = train if rows is None else rows
    # a bias is the key's mean less the global mean, which is one scalar
    # subquery: nothing runs while the plan is built
    g = train.agg(F.avg("label")).scalar()
    b_u = train.groupBy("user_id").agg(F.avg("label").alias("m_u"))
    b_i = train.groupBy("item_id").agg(F.avg("label").alias("m_i"))
    out = (
        rows.join(b_u, "user_id", "left")
        .join(b_i, "item_id", "left")
        .withColumn("global_mean", g)
        .withColumn("b_u", F.coalesce(F.col("m_u") - F.col("global_mean"), F.lit(0.0)))
        .withColumn("b_i", F.coalesce(F.col("m_i") - F.col("global_mean"), F.lit(0.0)))
        .drop("m_u", "m_i")
        .withColumn("baseline_pred", F.col("global_mean") + F.col("b_u") + F.col("b_i"))
    )
    if "label" in rows.columns:
        out = out.withColumn("residual", F.col("label") - F.col("baseline_pred"))
    return out


def trusted_rating_stats(rows: DataFrame, ratings: DataFrame, edges: DataFrame) -> DataFrame:
    """For each (user, item) row, statistics of the item's ratings by the
    users the row's user trusts directly (population variance); -1 for all
    six when none of them rated the item."""
    e = edges.select(F.col("trustor").alias("user_id"), F.col("trustee").alias("nbr")).distinct()
    r = ratings.select(F.col("user_id").alias("nbr"), "item_id", F.col("label").alias("nbr_label"))
    cand = rows.select("user_id", "item_id").join(e, "user_id").join(r, ["nbr", "item_id"])
    stats = cand.groupBy("user_id", "item_id").agg(
        F.avg("nbr_label").alias("avg_rating_trustees"),
        F.var_pop("nbr_label").alias("var_rating_trustees"),
        F.min("nbr_label").alias("min_rating_trustees"),
        F.max("nbr_label").alias("max_rating_trustees"),
        F.median("nbr_label").alias("median_rating_trustees"),
        F.count(F.lit(1)).cast("double").alias("num_trustees_rated"),
    )
    cols = ["avg_rating_trustees", "var_rating_trustees", "min_rating_trustees", "max_rating_trustees",
            "median_rating_trustees", "num_trustees_rated"]
    return rows.join(stats, ["user_id", "item_id"], "left").na.fill(-1.0, cols)


@dataclass
class Reach:
    """Who reaches whom within how many hops, 64 sources to a row.

    ``sources``: src, block, flag (one bit of the block's 64). ``hops``: block,
    node, hops, mask -- the sources of the block whose shortest way to the node
    has that many hops. A node stands once per block and hop, not once per source.
    """

    sources: DataFrame
    hops: DataFrame

    def with_sources(self, masked: DataFrame, mask: str) -> DataFrame:
        """``masked`` rows (with ``block`` and a bit mask) once per source whose bit is set, as ``src``."""
        members = self.sources.groupBy("block").agg(F.collect_list(F.struct("flag", "src")).alias("__members"))  # at most 64
        named = F.filter("__members", lambda m: m["flag"].bitwiseAND(F.col(mask)) != 0)
        return masked.join(members, "block").withColumn("__member", F.explode(named)).withColumn("src", F.col("__member.src")).drop("__members", "__member", "block", mask)

    def pairs(self) -> DataFrame:
        """(src, dst, hops), a row per source and user reached."""
        return self.with_sources(self.hops, "mask").select("src", F.col("node").alias("dst"), "hops")


def in_blocks(sources: DataFrame) -> DataFrame:
    """src, block and flag: distinct sources in order, 64 to a block (neighbours in order tend to reach the same users)."""
    src = sources.columns[0]
    seeds = sources.select(F.col(src).alias("src")).filter("src IS NOT NULL").distinct().repartitionByRange("src").sortWithinPartitions("src")
    numbered, _ = written(seeds.withColumn("__at", F.monotonically_increasing_id()), "khop-sources")
    return numbered.select("src", F.shiftright("__at", 6).alias("block"), F.expr("shiftleft(1L, CAST(__at & 63 AS INT))").alias("flag"))


def pack(pairs: DataFrame) -> Reach:
    """The block form of (src, dst, hops) rows."""
    sources = in_blocks(pairs.select("src"))
    hops = pairs.join(sources, "src").groupBy("block", F.col("dst").alias("node"), "hops").agg(F.bit_or("flag").alias("mask"))
    return Reach(sources, hops)


def khop_masks(edges: DataFrame, sources: DataFrame, max_depth: int = 9, src: str = "trustor", dst: str = "trustee") -> Reach:
    """Breadth-first search from all sources at once, 64 of them per machine word.

    The state is one row per (block of 64 sources, user): ``seen``, the sources
    that have reached the user, and ``new``, those that did so in the last hop.
    A hop joins the rows with new bits to the edges, combines the masks per
    (block, next user) with ``bit_or`` (map-side first) together with the state,
    and keeps ``found & ~seen``: one equi-join and one aggregate for 64 searches,
    and no anti-join against earlier hops. Every hop's state is a table in the
    shared folder, split into rows with new bits (kept: they are the result)
    and the others, which go as soon as the next hop stands. The loop ends when
    a hop finds nothing.
    """
    spark = edges.sparkSession
    e = cut_lineage(edges.select(F.col(src).alias("node"), F.col(dst).alias("next")).filter("node <> next").distinct().repartition("node"))
    blocks = in_blocks(sources)
    none = F.lit(0).cast("long")
    # a source has seen itself, so it is never its own neighbour
    state, fresh, stale = blocks.select("block", F.col("src").alias("node"), F.col("flag").alias("seen")), None, None
    frontier = state.withColumnRenamed("seen", "new")
    parts = []
    for hop in range(1, max_depth + 1):
        found = frontier.join(e, "node").select("block", F.col("next").alias("node"), none.alias("seen"), F.col("new").alias("found"))
        both = state.withColumn("found", none).unionByName(found).groupBy("block", "node").agg(F.bit_or("seen").alias("seen"), F.bit_or("found").alias("found"))
        new = F.col("found").bitwiseAND(F.bitwise_not("seen"))
        step, path = written(both.select("block", "node", F.col("seen").bitwiseOR(F.col("found")).alias("seen"), new.alias("new"), (new != 0).alias("fresh")), "khop-state", ("fresh",))
        if stale:
            remove_path(spark, stale)
        stale = f"{path}/fresh=false"
        fresh = step.filter("fresh")
        if fresh.isEmpty():
            break
        parts.append(fresh.select("block", "node", F.lit(hop).alias("hops"), F.col("new").alias("mask")))
        state, frontier = step.select("block", "node", "seen"), fresh.select("block", "node", "new")
    if stale:
        remove_path(spark, stale)
    kind = edges.schema[dst].dataType.simpleString()
    hops = spark.createDataFrame([], f"block long, node {kind}, hops int, mask long")
    for part in parts:
        hops = hops.unionByName(part) if part is not parts[0] else part
    return Reach(blocks, hops)


def khop_reach(edges: DataFrame, sources: DataFrame, max_depth: int = 9, src: str = "trustor", dst: str = "trustee") -> DataFrame:
    """(src, dst, hops) with the shortest hop count 1..max_depth from each
    source to every user it reaches, the source itself excluded; see ``khop_masks``."""
    return khop_masks(edges, sources, max_depth, src, dst).pairs()


def khop_rating_stats(rows: DataFrame, ratings: DataFrame, reach: Reach | DataFrame, depths: range = range(1, 10)) -> DataFrame:
    """For every (user, item) row and depth d, mean, population sd, count,
    median, min and max of the item's ratings by users within d hops;
    -1 (count 0) when there are none. ``reach`` may also be (src, dst, hops) rows.

    Reached users meet their ratings by block; only bits whose source asks for
    that item stay, equal masks are counted together, and only those counts are
    spread over the sources. So neither the reach nor the ratings are multiplied
    by sources that ask for something else. Everything else follows from the
    counts per (user, item, rating value): moments as weighted sums, min / max
    as the extreme values with a non-zero count, and the exact median from
    running counts in rating order (a window over one row's distinct rating
    values, never over its neighbours).
    """
    from pyspark.sql import Window

    if isinstance(reach, DataFrame):
        reach = pack(reach)
    key = ["user_id", "item_id"]
    asking = rows.select(F.col("user_id").alias("src"), "item_id").distinct().join(reach.sources, "src")
    asked = asking.groupBy("block", "item_id").agg(F.bit_or("flag").alias("asked"))
    r = ratings.select(F.col("user_id").alias("node"), "item_id", F.col("label").alias("v"))
    met = reach.hops.join(r, "node").join(asked, ["block", "item_id"]).withColumn("mask", F.col("mask").bitwiseAND(F.col("asked"))).filter("mask <> 0")
    met = met.groupBy("block", "item_id", "v", "hops", "mask").agg(F.count(F.lit(1)).alias("__n"))
    cand = reach.with_sources(met, "mask").withColumnRenamed("src", "user_id")
    counts = cand.groupBy(*key, "v").agg(
        *[F.coalesce(F.sum(F.when(F.col("hops") <= d, F.col("__n"))), F.lit(0)).alias(f"c{d}") for d in depths])
    upto = Window.partitionBy(*key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key)
    counts = counts.withColumn("__low", F.min("v").over(whole))
    for d in depths:
        counts = counts.withColumn(f"r{d}", F.sum(f"c{d}").over(upto)).withColumn(f"n{d}", F.sum(f"c{d}").over(whole))
    aggs = []
    for d in depths:
        c, n, run = F.col(f"c{d}"), F.col(f"n{d}"), F.col(f"r{d}")
        has = F.when(c > 0, F.col("v"))
        total = F.sum(c)
        mean = F.try_divide(F.sum(F.col("v") * c), total)
        # centred on the smallest value, so large ratings do not cancel
        off = F.col("v") - F.col("__low")
        var = F.greatest(F.lit(0.0), F.try_divide(F.sum(off * off * c), total) - F.pow(F.try_divide(F.sum(off * c), total), 2))
        lower = F.min(F.when(run >= F.floor((n + 1) / 2), F.col("v")))
        upper = F.min(F.when(run >= F.floor(n / 2) + 1, F.col("v")))
        aggs += [
            F.when(total > 0, mean).alias(f"trust_mean{d}"),
            F.when(total > 0, F.sqrt(var)).alias(f"trust_std{d}"),
            total.alias(f"trust_count{d}"),
            F.when(total > 0, (lower + upper) / 2).alias(f"median{d}"),
            F.min(has).alias(f"min{d}"),
            F.max(has).alias(f"max{d}"),
        ]
    stats = counts.groupBy(*key).agg(*aggs)
    out = rows.join(stats, key, "left")
    fills = {}
    for d in depths:
        fills[f"trust_count{d}"] = 0
        for s_ in ("trust_mean", "trust_std", "median", "min", "max"):
            fills[f"{s_}{d}"] = -1.0
    return out.na.fill(fills)


def rating_features(train: DataFrame, edges: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Rating rows with user features, baseline and residual, item
    statistics and trusted-user statistics (left joins on the keys).

    Every statistic comes from ``train`` only; ``rows`` (default: the training
    rows) are the rows to enrich, so held-out labels never reach a feature.
    """
    rows = train if rows is None else rows
    base = rating_baseline(train, rows).select("user_id", "item_id", "baseline_pred", "residual")
    items = item_rating_stats(train).select(
        "item_id", *[F.col(c).alias(f"item_{c}") for c in
                     ["average_rating", "variance_rating", "number_of_reviews", "min_rating", "max_rating",
                      "median_rating"]])
    return (
        trusted_rating_stats(rows, train, edges)
        .join(user_features(train, edges), "user_id", "left")
        .join(base, ["user_id", "item_id"], "left")
        .join(items, "item_id", "left")
    )
