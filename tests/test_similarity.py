"""The exact candidate join equals brute force (cross join used only here, as the check)."""

import pytest
from pyspark.sql import functions as F

from twingraph import fixtures as fx
from twingraph.functions import scores as S
from twingraph.operators import similarity as sim

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def graphs(spark):
    return fx.graph_pair(spark, SF_SMALL)


def _brute(g, t):
    o, p = sim.prefixed(g.o_nodes, "o_"), sim.prefixed(g.p_nodes, "p_")
    allp = o.crossJoin(p).select("o_id", "p_id", S.tolerant_points().alias("pts"))
    return allp.where(F.col("pts") >= t)


@pytest.mark.parametrize("t", [41, 55, 69])
def test_candidate_join_equals_brute_force(graphs, t):
    cand = sim.candidate_pairs(graphs.o_nodes, graphs.p_nodes, t)
    brute = _brute(graphs, t)
    assert cand.count() == brute.count()
    assert cand.exceptAll(brute).count() == 0


def test_branches_are_disjoint(graphs):
    cand = sim.candidate_pairs(graphs.o_nodes, graphs.p_nodes, 41)
    assert cand.count() == cand.select("o_id", "p_id").distinct().count()


def test_best_match_ladder_equals_plain(graphs):
    a = sim.best_match_exact(graphs.o_nodes, graphs.p_nodes)
    b = sim.best_match(_brute(graphs, 41))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_equal_nodes_and_large_values(spark, graphs):
    """Every copy of a node gets its match, ties go to the smallest id, large ranges need few buckets."""
    rows = [(i, 3, 4, 1, 1_000_000 + i // 2, 2, 5, 6, 0.0, i == 0) for i in range(6)]
    o = spark.createDataFrame(rows, graphs.o_nodes.schema)
    p = o.withColumn("id", F.col("id") + 100)
    best = {r["p_id"]: (r["o_id"], r["pts"]) for r in sim.best_match_exact(o, p).collect()}
    assert best == {100: (0, 90), **{100 + i: (0, 75) for i in range(1, 6)}}
    counted = {r["p_id"]: r["n_matches"] for r in sim.best_match_counted(o, p).collect()}
    assert counted == {100 + i: 6 for i in range(6)}


def test_top_k_ranks(graphs):
    cand = sim.candidate_pairs(graphs.o_nodes, graphs.p_nodes, 41)
    top2 = sim.best_match(cand, top_k=2)
    top1 = sim.best_match(cand, top_k=1)
    assert top2.where("rank = 1").select("p_id", "o_id", "pts", "score").exceptAll(top1).count() == 0
    assert top2.groupBy("p_id").count().agg(F.max("count")).first()[0] <= 2


@pytest.mark.parametrize("ladder", [(), (80, 69, 60, 50)])
def test_top_k_ladder_equals_brute_force(spark, graphs, ladder):
    """Bounds only decide when a profile stops; copies of a node count as matches of their own."""
    copies = graphs.o_nodes.where("id % 5 = 0").withColumn("id", F.col("id") + 100_000)
    o = graphs.o_nodes.unionByName(copies)
    got = sim.best_match_top(o, graphs.p_nodes, 3, ladder=ladder)
    allp = sim.prefixed(o, "o_").crossJoin(sim.prefixed(graphs.p_nodes, "p_")).select("o_id", "p_id", S.tolerant_points().alias("pts"))
    ranked = allp.where("pts >= 41").withColumn("rank", F.expr("row_number() over (partition by p_id order by pts desc, o_id)"))
    want = ranked.where("rank <= 3").select("p_id", "o_id", "pts", F.col("rank").cast("bigint").alias("rank"))
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


@pytest.mark.parametrize("t", [41, 50, 66])
def test_counts_equal_brute_force(spark, graphs, t):
    """Counting by classes and running sums gives the number of qualifying pairs, copies, zeros and nulls included."""
    extra = graphs.o_nodes.where("id < 40").withColumn("id", F.col("id") + 500_000).withColumn(
        "stored_value", F.when(F.col("id") % 4 == 0, F.lit(0.0)).when(F.col("id") % 4 == 1, F.lit(None)).otherwise(F.col("stored_value")))
    o = graphs.o_nodes.unionByName(extra).unionByName(extra.withColumn("id", F.col("id") + 1000).withColumn("prop_value_range", F.lit(None).cast("bigint")))
    p = graphs.p_nodes.unionByName(extra)
    # values at the very ends of a range: p / (1 + f) and p / (1 - f), and their neighbours
    f = S.tolerance(13.5)
    ends = p.where("id < 12").withColumn("stored_value", F.col("stored_value") / (1 + f)).unionByName(
        p.where("id < 12").withColumn("stored_value", F.col("stored_value") / (1 - f)))
    o = o.unionByName(ends.withColumn("id", F.monotonically_increasing_id() + 900_000))
    got = {r["p_id"]: r["n_matches"] for r in sim.expand(sim.match_counts(sim.profiles(o), sim.profiles(p), t), sim.profiles(p), p).collect()}
    allp = sim.prefixed(o, "o_").crossJoin(sim.prefixed(p, "p_")).select("p_id", S.tolerant_points().alias("pts"))
    want = {r["p_id"]: r["count"] for r in allp.where(F.col("pts") >= t).groupBy("p_id").count().collect()}
    assert {k: v for k, v in got.items() if v} == want
    with pytest.raises(ValueError):
        sim.match_counts(sim.profiles(o), sim.profiles(p), 25)
