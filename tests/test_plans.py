"""Plan checks: pushdown / pruning, bucketed edges, scratch tables; test_queries.py checks every query's plan."""

from twingraph.plans.queries import queries

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_valuable_filter_and_pruning_reach_scan(spark):
    p = _plan(queries()["q_valuable_nodes"](spark, SF_SMALL))
    assert "PushedFilters" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p


def test_a_path_level_moves_no_edges(spark):
    """The edge table of the searches is read in its buckets; only the frontier is exchanged or broadcast."""
    from twingraph.fixtures import graph_pair
    from twingraph.operators import paths
    from twingraph.operators.graph import undirected
    with paths._edge_table(undirected(graph_pair(spark, SF_SMALL).p_edges)) as edges:
        met = paths._meet(spark.range(50).withColumnRenamed("id", "node").hint("merge"), edges)
        plan = _plan(met).split("\n")
        at = [i for i, x in enumerate(plan) if "bucketed_" in x]
        exchanges = [i for i, x in enumerate(plan) if "Exchange" in x]
        assert len(at) == 1 and len(exchanges) == 1 and exchanges[0] < at[0]
        assert "Bucketed: true" in plan[at[0]] or "SelectedBucketsCount" in _plan(met)


def test_scope_removes_intermediate_tables(spark):
    from pyspark.sql import functions as F
    from twingraph.operators.kernel import cut_lineage
    from twingraph.session import path_exists, scratch_scope
    with scratch_scope(spark):
        df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 10 and path_exists(spark, path)
    assert not path_exists(spark, path)
