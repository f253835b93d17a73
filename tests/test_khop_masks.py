"""k-hop search on bit masks: many blocks, hubs, depth 14, and the same statistics from pairs or masks."""

import random
from collections import deque

from quarry.operators import graph as G
from quarry.session import path_exists


def bfs(edges, sources, depth):
    out = {}
    following = {}
    for a, b in edges:
        following.setdefault(a, set()).add(b)
    for s in sources:
        seen, queue = {s: 0}, deque([s])
        while queue:
            u = queue.popleft()
            if seen[u] < depth:
                for v in following.get(u, ()):
                    if v not in seen:
                        seen[v] = seen[u] + 1
                        queue.append(v)
        out |= {(s, v): h for v, h in seen.items() if h}
    return out


def test_many_blocks_equal_bfs_at_depths_nine_and_fourteen(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(500)] + [(i, i + 1) for i in range(500, 530)] + [(7, 7), (3, 500), (3, 500)]
    sources = list(range(0, 300)) + [9999]
    e, s = spark.createDataFrame(edges, "trustor long, trustee long"), spark.createDataFrame([(u,) for u in sources + [None, 5, 5]], "user_id long")
    for depth in (9, 14):
        reach = G.khop_masks(e, s, depth)
        want = bfs(edges, sources, depth)
        assert {(r.src, r.dst): r.hops for r in reach.pairs().collect()} == want
        assert reach.pairs().count() == len(want)
        assert reach.sources.groupBy("block").count().agg({"count": "max"}).first()[0] <= 64


def test_hub_is_one_row_a_block(spark):
    edges = [(u, 10**6) for u in range(6400)] + [(10**6, 10**6 + 1)]
    reach = G.khop_masks(spark.createDataFrame(edges, "trustor long, trustee long"), spark.range(6400), 9)
    blocks = reach.sources.select("block").distinct().count()
    assert 100 <= blocks <= 116
    assert reach.hops.groupBy("node").count().filter(f"count = {blocks}").count() == 2 and reach.hops.count() == 2 * blocks
    assert reach.pairs().count() == 2 * 6400


def test_no_sources_no_edges(spark):
    e = spark.createDataFrame([], "trustor long, trustee long")
    assert G.khop_reach(e, spark.range(3)).collect() == []
    some = spark.createDataFrame([(1, 2)], "trustor long, trustee long")
    assert G.khop_reach(some, spark.range(0)).collect() == []


def test_old_state_is_removed(spark, monkeypatch):
    paths = []
    real = G.written

    def noted(df, tag, by=()):
        out = real(df, tag, by)
        if by:
            paths.append(out[1])
        return out

    monkeypatch.setattr(G, "written", noted)
    e = spark.createDataFrame([(i, i + 1) for i in range(5)], "trustor long, trustee long")
    assert G.khop_reach(e, spark.range(2), 9).count() == 5 + 4
    assert len(paths) == 6 and all(not path_exists(spark, f"{p}/fresh=false") for p in paths)
    assert all(path_exists(spark, f"{p}/fresh=true") for p in paths[:5])


def test_statistics_from_masks_equal_those_from_pairs(spark):
    rng = random.Random(9)
    edges = spark.createDataFrame([(rng.randrange(150), rng.randrange(150)) for _ in range(400)], "trustor long, trustee long")
    given = {(rng.randrange(150), rng.randrange(12)): 1 + rng.randrange(9) / 2 for _ in range(500)}
    ratings = spark.createDataFrame([(u, i, v) for (u, i), v in given.items()], "user_id long, item_id int, label double")
    rows = ratings.filter("item_id < 6")
    reach = G.khop_masks(edges, rows.select("user_id"), 4)
    by_masks, by_pairs = (G.khop_rating_stats(rows, ratings, r, range(1, 5)).collect() for r in (reach, reach.pairs()))
    assert sorted(map(str, by_masks)) == sorted(map(str, by_pairs))
    pairs = {(r.src, r.dst): r.hops for r in reach.pairs().collect()}
    for r in by_masks[:60]:
        for d in range(1, 5):
            near = [v for (u, i), v in given.items() if i == r.item_id and pairs.get((r.user_id, u), 99) <= d]
            assert r[f"trust_count{d}"] == len(near)
            assert abs(r[f"trust_mean{d}"] - (sum(near) / len(near) if near else -1)) < 1e-9
            assert r[f"max{d}"] == max(near, default=-1)
