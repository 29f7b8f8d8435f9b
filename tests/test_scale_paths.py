"""Searches and walks hash their frontier: it is neither broadcast, nor are the edges sorted."""

from twingraph.operators import paths, walks
from twingraph.operators.kernel import Bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _edges(spark):
    return spark.range(200).selectExpr("id % 20 as src", "id as dst", "cast(1 as double) as weight")


def test_a_frontier_is_never_broadcast(spark):
    with paths._edge_table(_edges(spark).selectExpr("src as node", "dst as nbr")) as edges:
        plan = _plan(paths._meet(spark.range(5).selectExpr("id as node"), edges))
        assert "BroadcastExchange" not in plan and "ShuffledHashJoin" in plan


def test_a_walk_step_sorts_no_neighbours(spark):
    with Bucketed(walks.neighbour_table(_edges(spark)), ["node", "pos"]) as nbrs:
        frontier = spark.range(10).selectExpr("id as walk_id", "id as at", "cast(2 as bigint) as deg")
        plan = _plan(walks.take_step(frontier, nbrs.table(), 1, 42, "n0"))
        assert "ShuffledHashJoin" in plan and "Sort " not in plan
