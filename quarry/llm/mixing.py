"""Mixing overlapping sources to target weights by min-cost flow (operator 9).

A document may belong to several sources. Documents are aggregated by their
membership pattern; only those sums (one row per pattern, not per document)
reach the driver, where tokens are routed pattern -> source -> quota. The first
copy of a pattern costs nothing, the second and third cost more and more
(convex), so the flow repeats documents only when quotas need it. Each
pattern's routed tokens then become whole copies for all its documents plus one
more copy for a seeded prefix. The prefix is found from sums per hash bucket;
only the bucket at the boundary is ordered row by row, so a source with a third
of all rows is never sorted in one task.

Defined results: null text has size 0; a null source is a source of its own,
ordered last; documents of size 0 take 0; repeated rows count each on its own;
an empty table gives an empty mix; other columns of the input are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD, saved

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
COPY_COSTS = (0, 1, 3)
SEED = "mix-1"
#: Hash buckets per pattern for the prefix search (three hex digits).
BUCKET_DIGITS = 3
#: Patterns or sources whose facts (one short row each) may be broadcast.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share_out(total: float, weights: dict, caps: dict) -> dict:
    """Split ``total`` by weight; shares stop at their cap and the excess is shared again until none is above."""
    out = dict.fromkeys(weights, 0.0)
    open_, left = set(weights), float(total)
    while open_:
        rate = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if rate * weights[s] >= caps[s]}
        for s in full or open_:
            out[s] = float(caps[s]) if full else rate * weights[s]
        if not full:
            break
        left -= sum(caps[s] for s in sorted(full, key=lambda s: (s is None, s or "")))
        open_ -= full
    return out


def route(patterns: list[tuple], quotas: dict, costs=COPY_COSTS) -> list[dict]:
    """Min-cost flow. ``patterns``: (sources, tokens); returns routed tokens per source for each.

    Successive cheapest augmenting paths. The graph splits by sources that
    share a pattern, and each part is solved alone.
    """
    root = {s: s for s in quotas}

    def find(s):
        while root[s] != s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for members, _ in patterns:
        for s in members[1:]:
            root[find(s)] = find(members[0])
    parts = defaultdict(list)
    for i, (members, tokens) in enumerate(patterns):
        if members and tokens:
            parts[find(members[0])].append(i)
    out: list[dict] = [{} for _ in patterns]
    for ids in parts.values():
        for i, flow in zip(ids, _route_part([patterns[i] for i in ids], quotas, costs), strict=True):
            out[i] = flow
    return out


def _route_part(patterns, quotas, costs):
    edges = []  # to, capacity, cost; the reverse edge is next to it
    graph = defaultdict(list)

    def edge(a, b, cap, cost):
        for x, y, c, w in ((a, b, cap, cost), (b, a, 0.0, -cost)):
            graph[x].append(len(edges))
            edges.append([y, c, w])

    routed = {}
    for i, (members, tokens) in enumerate(patterns):
        for c in costs:
            edge("in", ("p", i), float(tokens), c)
        for s in members:
            routed[i, s] = len(edges)
            edge(("p", i), ("s", s), float(tokens) * len(costs), 0)
    for s in dict.fromkeys(s for members, _ in patterns for s in members):
        edge(("s", s), "out", float(quotas[s]), 0)
    least = 1e-9 * max(1.0, sum(t for _, t in patterns))
    while True:
        cost, via, queue = {"in": 0}, {}, ["in"]
        while queue:
            nodes, queue = queue, []
            for a in nodes:
                for k in graph[a]:
                    b, cap, w = edges[k]
                    if cap > least and cost[a] + w < cost.get(b, float("inf")):
                        cost[b], via[b] = cost[a] + w, k
                        queue.append(b)
        if "out" not in cost:
            break
        path, b = [], "out"
        while b != "in":
            path.append(via[b])
            b = edges[via[b] ^ 1][0]
        amount = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= amount
            edges[k ^ 1][1] += amount
    return [{s: edges[routed[i, s] ^ 1][1] for s in members} for i, (members, _) in enumerate(patterns)]


def copies(sized: DataFrame, quotas=None, seed: str = SEED) -> tuple[DataFrame, dict, dict]:
    """Copies of each document.

    ``sized`` has doc_id, size and ``sources`` (array of source names, null
    allowed); other columns are carried along. ``quotas``: tokens wanted per
    source, or a function of the source sizes; by default all tokens, shared by
    WEIGHTS. Returns the rows with ``_copies`` int added, the quotas and the
    source sizes.
    """
    spark = sized.sparkSession
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # a pattern is its sorted distinct names as JSON
    rows = saved(sized.withColumns({
        "_pattern": F.coalesce(F.to_json(F.array_sort(F.array_distinct("sources"))), F.lit("[]")),
        "_order": order, "_bucket": F.substring(order, 1, BUCKET_DIGITS)}), "mix")
    cells = saved(rows.groupBy("_pattern", "_bucket").agg(F.sum("size").alias("_cell"), F.first("sources").alias("_sources")), "mix-cells")
    sums = sorted((r["_pattern"], r["_sources"], int(r["_tokens"])) for r in cells.groupBy("_pattern").agg(
        F.sum("_cell").alias("_tokens"), F.first("_sources").alias("_sources")).collect())
    patterns = [(list(dict.fromkeys(s or ())), t) for _, s, t in sums]
    size_of: dict = defaultdict(int)
    for members, tokens in patterns:
        for s in members:
            size_of[s] += tokens
    names = sorted(size_of, key=lambda s: (s is None, s or ""))
    if quotas is None:
        weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
        quotas = share_out(sum(t for m, t in patterns if m), weights, {s: MAX_COPIES * size_of[s] for s in names})
    elif callable(quotas):
        quotas = quotas({s: size_of[s] for s in names})
    plan = []
    for (key, _, tokens), flow in zip(sums, route(patterns, quotas), strict=True):
        want = sum(flow.values())
        whole = min(int(want // tokens), len(COPY_COSTS)) if tokens else 0
        plan.append((key, whole, want - whole * tokens if whole < len(COPY_COSTS) else 0.0))
    plan = small(spark.createDataFrame(plan, "_pattern string, _whole int, _rest double"), len(sums))
    # the bucket in which each pattern's prefix ends, and the tokens before it
    before = F.sum("_cell").over(Window.partitionBy("_pattern").orderBy("_bucket")) - F.col("_cell")
    ends = cells.withColumn("_before", before).join(plan, "_pattern").filter(
        (F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_cell") >= F.col("_rest")))
    ends = plan.join(ends.select("_pattern", F.col("_bucket").alias("_cut"), "_before"), "_pattern", "left")
    rows = rows.join(small(saved(ends, "mix-ends"), len(sums)), "_pattern")
    # buckets before the cut are in whole; only the rows of the cut's own bucket are put in order
    inner = rows.filter(F.coalesce(F.col("_bucket") != F.col("_cut"), F.lit(True)))
    inner = inner.withColumn("_more", F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False)).cast("int"))
    window = Window.partitionBy("_pattern").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("_before") + F.sum("size").over(window) - F.col("size") / 2
    cut = rows.filter(F.col("_bucket") == F.col("_cut")).withColumn("_more", (middle <= F.col("_rest")).cast("int"))
    out = inner.unionByName(cut).withColumn("_copies", F.col("_whole") + F.col("_more"))
    return out.drop("_pattern", "_bucket", "_cut", "_before", "_whole", "_rest", "_more", "_order"), quotas, dict(size_of)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a side whose rows were counted; beyond the bound Spark shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _sized(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(*columns, word_count(F.col("text")).alias("size"), F.array(F.col("source").cast("string")).alias("sources"))


def mix_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and copies for every document, each in one source."""
    rows, quotas, sizes = copies(_sized(docs, "doc_id", "source"), seed=seed)
    facts = docs.sparkSession.createDataFrame([(s, int(sizes[s]), float(t)) for s, t in quotas.items()], "_s string, source_size bigint, target double")
    return rows.join(small(facts, len(quotas)), F.col("source").cast("string").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("size") * F.col("_copies")).alias("taken"), F.col("_copies").alias("copies"))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: ``docs`` with each document as many times as it is taken."""
    packed = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "source", "text")
    rows, _, _ = copies(_sized(packed, "_doc", "doc_id"), seed=seed)
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select("_doc.*")
