"""Confidence that a node survived the perturbation.

score = 0 when the node (compared by value) is absent from P or has no edge
in O; otherwise min(1, (1 + m) / n) with n its O-degree and m the edges
incident to it in both graphs, counted only when its O- and P-degrees agree.
Edges of both graphs are counted together: one aggregate per edge, one per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import NODE_PROPS


def _incidence(o_edges: DataFrame, p_edges: DataFrame) -> DataFrame:
    """Per node ``(node, n, m, deg_o, deg_p)``: incident O edges, edges in both graphs, both degrees.

    One union of flagged edges and one aggregate per edge and per node. Incident
    edges are a set, so a self loop is one of them; in a degree it counts twice.
    """
    flagged = (o_edges.select("src", "dst", F.lit(1).alias("o"), F.lit(0).alias("p"))
               .unionByName(p_edges.select("src", "dst", F.lit(0).alias("o"), F.lit(1).alias("p"))))
    edges = flagged.groupBy("src", "dst").agg(F.max("o").alias("o"), F.max("p").alias("p"))
    loop = F.col("src") == F.col("dst")
    ends = edges.select(F.explode(F.when(loop, F.array("src")).otherwise(F.array("src", "dst"))).alias("node"),
                        "o", "p", F.when(loop, F.lit(2)).otherwise(F.lit(1)).alias("_w"))
    return ends.groupBy("node").agg(
        F.sum("o").alias("n"), F.sum(F.col("o") * F.col("p")).alias("m"),
        F.sum(F.col("o") * F.col("_w")).alias("deg_o"), F.sum(F.col("p") * F.col("_w")).alias("deg_p"))


def _present(o_nodes: DataFrame, p_nodes: DataFrame) -> DataFrame:
    """Every O id with ``present``: whether the P node of that id holds the same values (ids are unique)."""
    o = o_nodes.select("id", F.struct(*NODE_PROPS).alias("_o"))
    p = p_nodes.select(F.col("id").alias("_pid"), F.struct(*NODE_PROPS).alias("_p"))
    return (o.join(p, o["id"] == p["_pid"], "left")
            .select("id", (F.col("_pid").isNotNull() & F.col("_o").eqNullSafe(F.col("_p"))).alias("present")))


def _score(n, m, present, same_deg):
    counted = F.when(same_deg, m).otherwise(F.lit(0))
    return (F.when(~present | (n == 0), F.lit(0.0))
            .otherwise(F.least(F.lit(1.0), (counted + 1).cast("double") / n.cast("double"))))


def confidence(o_nodes: DataFrame, o_edges: DataFrame, p_nodes: DataFrame, p_edges: DataFrame) -> DataFrame:
    """C1 for every original node: ``(id, n_edges, shared, same_degree, present, score)``."""
    base = _present(o_nodes, p_nodes)
    inc = _incidence(o_edges, p_edges)
    res = base.join(inc, base["id"] == inc["node"], "left")
    n, m = F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0))
    same = F.coalesce("deg_o", F.lit(0)) == F.coalesce("deg_p", F.lit(0))
    return res.select("id", n.cast("bigint").alias("n_edges"), m.cast("bigint").alias("shared"),
                      same.alias("same_degree"), "present", _score(n, m, F.col("present"), same).alias("score"))


def confidence_pairs(pairs: DataFrame, o_nodes: DataFrame, o_edges: DataFrame,
                     p_nodes: DataFrame, p_edges: DataFrame) -> DataFrame:
    """C2 for supplied ``(original_id, perturbed_id)`` pairs.

    n and the presence test use the original node; the loop runs over the
    original node's incident edges in P and keeps those that are incident to
    the *perturbed* node in O (an edge is incident to both only when it joins
    them), counted only when the original node's O- and P-degrees agree.
    """
    inc = _incidence(o_edges, p_edges).select(F.col("node").alias("original_id"), "n", "deg_o", "deg_p")
    present = _present(o_nodes, p_nodes).withColumnRenamed("id", "original_id")
    # P edges incident to the original node that are O edges incident to the perturbed node.
    pe = p_edges.select("src", "dst")
    oe = o_edges.select("src", "dst")
    both = pe.join(oe, ["src", "dst"])
    pr = pairs.select("original_id", "perturbed_id")
    fwd = pr.join(both, (pr["original_id"] == both["src"]) & (pr["perturbed_id"] == both["dst"]))
    bwd = pr.join(both, (pr["original_id"] == both["dst"]) & (pr["perturbed_id"] == both["src"]))
    hits = fwd.select("original_id", "perturbed_id", "src", "dst").unionByName(
        bwd.select("original_id", "perturbed_id", "src", "dst"))
    # Self pairs share every common incident edge.
    self_hits = (pr.where(F.col("original_id") == F.col("perturbed_id"))
                 .join(both.select(F.col("src").alias("node"), "src", "dst")
                       .unionByName(both.select(F.col("dst").alias("node"), "src", "dst")),
                       F.col("original_id") == F.col("node"))
                 .select("original_id", "perturbed_id", "src", "dst"))
    hit = (hits.where(F.col("original_id") != F.col("perturbed_id")).unionByName(self_hits)
           .distinct().groupBy("original_id", "perturbed_id").agg(F.count(F.lit(1)).alias("m")))
    res = (pr.join(present, "original_id", "left").join(inc, "original_id", "left")
           .join(hit, ["original_id", "perturbed_id"], "left"))
    n, m = F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0))
    same = F.coalesce("deg_o", F.lit(0)) == F.coalesce("deg_p", F.lit(0))
    pres = F.coalesce("present", F.lit(False))
    return res.select("original_id", "perturbed_id", n.cast("bigint").alias("n_edges"),
                      m.cast("bigint").alias("shared"), _score(n, m, pres, same).alias("score"))
