"""Perturbation diff between an original and a perturbed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import NODE_PROPS


def node_diff(o_nodes: DataFrame, p_nodes: DataFrame) -> DataFrame:
    """``(id, change, changed_cols)``; one full outer join on id.

    ``change`` is Added / Removed / Modified / Same; ``changed_cols`` lists
    the columns that differ (NULL for Added and Removed).
    """
    o = o_nodes.select("id", *[F.col(c).alias(f"o_{c}") for c in NODE_PROPS], F.lit(True).alias("_o"))
    p = p_nodes.select("id", *[F.col(c).alias(f"p_{c}") for c in NODE_PROPS], F.lit(True).alias("_p"))
    j = o.join(p, "id", "full_outer")
    diffs = [F.when(~F.col(f"o_{c}").eqNullSafe(F.col(f"p_{c}")), F.lit(c)) for c in NODE_PROPS]
    both = F.col("_o").isNotNull() & F.col("_p").isNotNull()
    cols = F.when(both, F.concat_ws(",", *diffs))
    change = (F.when(F.col("_o").isNull(), F.lit("Added"))
              .when(F.col("_p").isNull(), F.lit("Removed"))
              .when(cols != "", F.lit("Modified"))
              .otherwise(F.lit("Same")))
    return j.select("id", change.alias("change"), cols.alias("changed_cols"))


def edge_diff(o_edges: DataFrame, p_edges: DataFrame) -> DataFrame:
    """``(src, dst, change, o_weight, p_weight)``; one full outer join.

    Presence is flagged: an edge without a weight is still an edge, and two null weights are equal.
    """
    o = o_edges.select("src", "dst", F.col("weight").alias("o_weight"), F.lit(True).alias("_o"))
    p = p_edges.select("src", "dst", F.col("weight").alias("p_weight"), F.lit(True).alias("_p"))
    j = o.join(p, ["src", "dst"], "full_outer")
    change = (F.when(F.col("_o").isNull(), F.lit("Added"))
              .when(F.col("_p").isNull(), F.lit("Removed"))
              .when(~F.col("o_weight").eqNullSafe(F.col("p_weight")), F.lit("Modified"))
              .otherwise(F.lit("Same")))
    return j.select("src", "dst", change.alias("change"), "o_weight", "p_weight")


def diff_summary(node_d: DataFrame, edge_d: DataFrame) -> DataFrame:
    """``(entity, change, n)``."""
    n = node_d.select(F.lit("node").alias("entity"), "change")
    e = edge_d.select(F.lit("edge").alias("entity"), "change")
    return n.unionByName(e).groupBy("entity", "change").agg(F.count(F.lit(1)).alias("n"))


def reconcile(diff: DataFrame, report: DataFrame) -> DataFrame:
    """T4: compare a set difference with an operation-log report.

    ``diff`` and ``report`` are DELTA rows ``(entity, change, a, b)``.
    Returns each distinct row with ``in_diff``/``in_report`` flags.
    """
    keys = ["entity", "change", "a", "b"]
    d = diff.select(*keys).distinct().withColumn("in_diff", F.lit(True))
    r = report.select(*[F.col(k).alias(f"r_{k}") for k in keys]).distinct().withColumn("in_report", F.lit(True))
    j = d.join(r, [d[k].eqNullSafe(r[f"r_{k}"]) for k in keys], "full_outer")  # b is NULL for node lists
    return j.select(*[F.coalesce(F.col(k), F.col(f"r_{k}")).alias(k) for k in keys],
                    F.coalesce("in_diff", F.lit(False)).alias("in_diff"),
                    F.coalesce("in_report", F.lit(False)).alias("in_report"))


def as_delta(node_d: DataFrame, edge_d: DataFrame, p_edges: DataFrame) -> DataFrame:
    """Diff rows in the DELTA shape of the perturbation report.

    Modified / Removed nodes: ``a = id``; an Added node is listed under its
    parent (``a`` = smallest predecessor in P, -1 when it has none, ``b`` = id);
    edges: ``a = src, b = dst``.
    """
    listed = node_d.where(F.col("change").isin("Modified", "Removed")).select(
        F.lit("Nodes").alias("entity"), "change", F.col("id").alias("a"), F.lit(None).cast("bigint").alias("b"))
    added = node_d.where(F.col("change") == "Added").select("id")
    parent = p_edges.groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("parent"))
    n = listed.unionByName(added.join(parent, "id", "left").select(
        F.lit("Nodes").alias("entity"), F.lit("Added").alias("change"),
        F.coalesce("parent", F.lit(-1)).cast("bigint").alias("a"), F.col("id").alias("b")))
    e = edge_d.where(F.col("change") != "Same").select(
        F.lit("Edges").alias("entity"), "change", F.col("src").alias("a"), F.col("dst").alias("b"))
    return n.unionByName(e)
