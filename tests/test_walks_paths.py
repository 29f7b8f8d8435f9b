"""Invariants of walks and shortest paths."""

from collections import deque

import pytest
from pyspark.sql import functions as F

from twingraph import fixtures as fx
from twingraph.operators import graph, paths, walks

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def g(spark):
    return fx.graph_pair(spark, SF_SMALL)


def test_walk_steps_are_edges_and_deterministic(spark, g):
    w = walks.random_walks(spark, g.p_edges, n_walks=40, seed=7, max_steps=12)
    nxt = w.select("walk_id", (F.col("step") - 1).alias("step"), F.col("node_id").alias("dst"))
    hops = w.join(nxt, ["walk_id", "step"]).select(F.col("node_id").alias("src"), "dst")
    assert hops.join(g.p_edges, ["src", "dst"], "left_anti").count() == 0
    start = graph.walk_start(g.p_edges).first()["start_id"]
    assert w.where("step = 0").select("node_id").distinct().first()[0] == start
    assert w.groupBy("walk_id").count().agg(F.max("count")).first()[0] <= 12
    w2 = walks.random_walks(spark, g.p_edges, n_walks=40, seed=7, max_steps=12)
    assert w.exceptAll(w2).count() == 0


def test_walks_stop_at_sinks(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (1, 4, 1.0)], "src long, dst long, weight double")
    start = spark.createDataFrame([(1,)], "start_id long")
    w = walks.random_walks(spark, e, n_walks=30, seed=1, max_steps=10, start=start)
    lengths = {r["walk_id"]: r["count"] for r in w.groupBy("walk_id").count().collect()}
    assert set(lengths.values()) <= {2, 3}  # 1->4 (sink) or 1->2->3 (sink)


def _bfs(adj, sources):
    dist = {s: 0 for s in sources}
    q = deque(sources)
    while q:
        u = q.popleft()
        for v in adj.get(u, ()):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    return dist


def test_nearest_valuable_equals_python_bfs(g):
    res = paths.nearest_valuable(g.p_nodes, g.p_edges, paths=True).collect()
    adj = {}
    for r in g.p_edges.collect():
        adj.setdefault(r["src"], set()).add(r["dst"])
        adj.setdefault(r["dst"], set()).add(r["src"])
    val = [r["id"] for r in g.p_nodes.where("valuable_data").collect()]
    dist = _bfs(adj, val)
    for r in res:
        assert r["hops"] == dist.get(r["id"], 2147483647)
        if r["id"] in dist:
            path = [int(x) for x in r["path"].split(",")]
            assert len(path) == r["hops"] + 1 and path[0] == r["id"] and path[-1] == r["target"]
            assert all(b in adj[a] for a, b in zip(path, path[1:]))
        else:
            assert r["path"] == "" and r["target"] is None


def test_small_graph_hops(spark):
    # chain 0-1-2-3-4-5 with valuable 5 plus a shortcut 0-4
    nodes = spark.createDataFrame([(i, 0.5, i == 5) for i in range(7)], "id long, stored_value double, valuable_data boolean")
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(5)] + [(0, 4, 1.0)], "src long, dst long, weight double")
    r = {x["id"]: x for x in paths.nearest_valuable(nodes, edges, paths=True).collect()}
    assert [r[i]["hops"] for i in range(6)] == [2, 3, 3, 2, 1, 0]
    assert r[6]["hops"] == 2147483647 and r[6]["distance"] is None
    assert r[0]["path"] == "0,4,5" and r[0]["distance"] == 1.0


def test_long_chain_paths_and_weights(spark):
    # 0 - 1 - ... - 20, valuable 0; a heavy shortcut 0 - 20 is one hop but 100 away; 30 is alone
    ids = [*range(21), 30]
    nodes = spark.createDataFrame([(i, 1.0, i == 0) for i in ids], "id long, stored_value double, valuable_data boolean")
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(20)] + [(0, 20, 100.0), (3, 30, None)],
                                  "src long, dst long, weight double")
    chain = edges.where("weight = 1.0")
    r = {x["id"]: x for x in paths.nearest_valuable(nodes, chain, paths=True).collect()}
    assert r[20]["hops"] == 20 and r[20]["path"] == ",".join(str(i) for i in range(20, -1, -1))
    assert r[0]["path"] == "0" and r[30]["path"] == ""
    assert {x["id"]: x["hops"] for x in paths.nearest_valuable(nodes, edges).collect()}[20] == 1
    w = {x["id"]: x for x in paths.nearest_valuable_weighted(nodes, edges).collect()}
    assert w[20]["distance"] == 20.0 and w[20]["target"] == 0 and w[0]["distance"] == 0.0
    assert w[30]["distance"] is None and w[30]["target"] is None  # its only edge has no weight
    none = paths.nearest_valuable(nodes.where("id = 5"), edges, paths=True).collect()
    assert none[0]["hops"] == 2147483647 and none[0]["path"] == ""


def test_weighted_distances_equal_dijkstra(spark):
    """Zero weights, ties, parallel directions, isolated nodes; any width of the buckets."""
    import heapq
    import random
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60), rng.choice([0.0, 0.5, 1.0, 2.5, 7.0, 20.0, None])) for _ in range(130)]
    edges = spark.createDataFrame(links, "src long, dst long, weight double").dropDuplicates(["src", "dst"])
    kept = [tuple(r) for r in edges.collect()]
    sources = spark.createDataFrame([(3,), (17,), (90,)], "node long")
    best = {}
    heap = [(0.0, s, s) for s in (3, 17, 90)]
    while heap:
        d, target, node = heapq.heappop(heap)
        if node in best:
            continue
        best[node] = (d, target)
        for a, b, w in kept:
            for x, y in ((a, b), (b, a)):
                if x == node and w is not None and y not in best:
                    heapq.heappush(heap, (d + w, target, y))
    for width in (None, 0.3, 100.0):
        got = {r["node"]: (r["distance"], r["target"]) for r in paths.weighted(sources, edges, width).collect()}
        assert got == best
    with pytest.raises(ValueError):
        paths.weighted(sources, spark.createDataFrame([(1, 2, -1.0)], "src long, dst long, weight double"))


@pytest.mark.parametrize("values", [[5], [1, 2], [7, 7, 7, 7], [3, 1, 2, 2, 9], [-2**62, 2**62, 0, 5], [-2**63, 2**63 - 1, 2**63 - 2, 2**63 - 2**53 - 1, -1], list(range(0, 10**13, 10**10 + 7)), []])
def test_selected_ranks(spark, values):
    """The median by selection equals the sorted list's, for odd, even and tied counts and wide ranges."""
    from twingraph.operators.kernel import select_ranks
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    ranks = [0, len(values) // 2, max(len(values) - 1, 0) // 2, len(values) - 1, len(values)]
    assert select_ranks(df, "v", ranks) == [sorted(values)[r] if 0 <= r < len(values) else None for r in ranks]
    w = spark.createDataFrame([(0, i + 1, v) for i, v in enumerate(values)], "walk_id long, step long, node_id long")
    r = walks.walk_stats(None, w, over="node_id").first()
    n, o = len(values), sorted(values)
    assert r["n"] == n and r["median_v"] == ((o[(n - 1) // 2] + o[n // 2]) / 2 if n else None)


def test_dense_adjacency_in_tiles(spark):
    e = spark.createDataFrame([(1, 2, 4.0), (2, 3, 1.0), (3, 1, 2.5), (3, 8, 1.0), (1, 1, 6.0), (2, 1, None)], "src long, dst long, weight double")
    ids = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,), (70,), (5,)], "id long")
    want = {1: [6.0, 4.0, None, None, None], 2: [None, None, 1.0, None, None], 3: [2.5, None, None, None, None], 5: [None] * 5, 70: [None] * 5}
    for tile in (1, 2, 256):
        assert {r["node"]: r["costs"] for r in graph.adjacency_dense(ids, e, tile).collect()} == want
        assert {len(r["costs"]) for r in graph.adjacency_tiles(ids, e, tile).collect()} <= {1, tile, 5}
    assert graph.adjacency_dense(ids.where("id < 0"), e).count() == 0


def _exchanges(df):
    """Lines of the plan that shuffle or broadcast, and those that read the bucketed table."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [x.strip() for x in plan if "Exchange" in x], [x for x in plan if "bucketed_" in x]


def test_a_walk_step_exchanges_only_the_frontier(spark, g):
    from twingraph.operators.kernel import Bucketed
    with Bucketed(walks.neighbour_table(g.p_edges), ["node", "pos"]) as nbrs:
        frontier = spark.range(100).selectExpr("id as walk_id", "id as at", "cast(2 as bigint) as deg")
        one = walks.take_step(frontier, nbrs.table(), 1, 42, "n0")
        three = walks.take_step(walks.take_step(one, nbrs.table(), 2, 42, "n1"), nbrs.table(), 3, 42, "n2")
        for df, steps in ((one, 1), (three, 3)):
            moved, read = _exchanges(df)
            assert len(moved) == steps and len(read) == steps
            assert all("hashpartitioning(_at" in x for x in moved)
        assert spark.table(nbrs.name).count() > 0
    assert nbrs.name not in [t.name for t in spark.catalog.listTables()]


def test_jitter_is_seeded_and_bounded(spark):
    from twingraph.functions import scores as S
    df = spark.range(0, 1000).select(F.col("id"), S.jitter(F.lit(0.5), "id", F.lit(1), 42).alias("j"))
    lo, hi = df.agg(F.min("j"), F.max("j")).first()
    assert 0.4 <= lo < 0.45 and 0.55 < hi < 0.6
    again = spark.range(0, 1000).select(F.col("id"), S.jitter(F.lit(0.5), "id", F.lit(1), 42).alias("j"))
    assert df.exceptAll(again).count() == 0


def test_graphs_without_edges(spark):
    """Searches reach their sources alone; a walk without a start has no rows, one from a node without edges has one."""
    none = spark.createDataFrame([], "src long, dst long, weight double")
    sources = spark.createDataFrame([(4,), (7,), (None,)], "node long")
    assert sorted((r["node"], r["hops"], r["target"]) for r in paths.bfs(sources, none).collect()) == [(4, 0, 4), (7, 0, 7)]
    assert sorted(map(tuple, paths.weighted(sources, none).collect())) == [(4, 0.0, 4), (7, 0.0, 7)]
    assert walks.random_walks(spark, none, n_walks=3, max_steps=4).count() == 0
    start = spark.createDataFrame([(9,)], "start_id long")
    assert sorted(map(tuple, walks.random_walks(spark, none, n_walks=2, max_steps=4, start=start).collect())) == [(0, 0, 9), (1, 0, 9)]
    one = spark.createDataFrame([(1, 2, 1.0)], "src long, dst long, weight double")
    w = walks.random_walks(spark, one, n_walks=2, max_steps=1, start=spark.createDataFrame([(1,)], "start_id long"))
    assert sorted(map(tuple, w.collect())) == [(0, 0, 1), (1, 0, 1)]
