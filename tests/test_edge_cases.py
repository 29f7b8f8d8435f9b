"""Null weights and self loops: an edge without a weight is an edge, a loop is one incident edge."""

from pyspark.sql import functions as F

from twingraph.fixtures import original_nodes, perturbed_nodes
from twingraph.operators import confidence, diff, graph, similarity

SF = "/root/testdata/sf0.001"
EDGES = "src long, dst long, weight double"


def test_edge_diff_with_null_weights(spark):
    o = spark.createDataFrame([(1, 2, None), (2, 3, 1.0), (3, 4, None), (4, 5, 2.0), (6, 7, None)], EDGES)
    p = spark.createDataFrame([(1, 2, None), (2, 3, None), (3, 4, 5.0), (4, 5, 2.0), (8, 9, None)], EDGES)
    got = {(r.src, r.dst): r.change for r in diff.edge_diff(o, p).collect()}
    assert got == {(1, 2): "Same", (2, 3): "Modified", (3, 4): "Modified", (4, 5): "Same", (6, 7): "Removed", (8, 9): "Added"}
    pairs = {(r.src, r.dst): (r.in_o, r.in_p) for r in similarity.edge_pairs(o, p).collect()}
    assert pairs[(1, 2)] == (True, True) and pairs[(6, 7)] == (True, False) and pairs[(8, 9)] == (False, True)


def test_self_loops_count_once_as_incident(spark):
    nodes = original_nodes(spark, SF).where("id < 3")
    edges = spark.createDataFrame([(0, 0, 1.0), (0, 1, 1.0)], EDGES)
    c1 = {r.id: r for r in confidence.confidence(nodes, edges, nodes, edges).collect()}
    assert (c1[0].n_edges, c1[0].shared, c1[0].same_degree) == (2, 2, True)
    pair = spark.createDataFrame([(0, 0)], "original_id long, perturbed_id long")
    c2 = confidence.confidence_pairs(pair, nodes, edges, nodes, edges).first()
    assert (c2.n_edges, c2.shared, c2.score) == (2, 2, c1[0].score)
    assert graph.incident_edges(edges).where("node = 0").count() == 2
    d = {r.id: (r.in_deg, r.out_deg, r.degree) for r in graph.degrees(nodes, edges).collect()}
    assert d == {0: (1, 2, 3), 1: (1, 0, 1), 2: (0, 0, 0)}
    j = {r.id: (r.inter, r.uni) for r in similarity.edge_set_jaccard(nodes, edges, nodes, edges).collect()}
    assert j[0] == (2, 2) and j[1] == (1, 1)


def test_added_ids_stay_unique_for_a_large_part_table(spark):
    n = 1_000_200
    o = spark.range(n).select("id", *[F.lit(1).cast("bigint").alias(c) for c in (
        "children", "props", "current_depth", "prop_value_range", "max_depth", "max_branching_factor", "max_properties")],
        F.lit(0.5).alias("stored_value"), F.lit(False).alias("valuable_data"))
    p = perturbed_nodes(o, n)
    assert p.count() == p.select("id").distinct().count()
