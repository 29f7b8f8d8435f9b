"""Graph-structure operators on an edge DataFrame ``(src, dst, weight)``.

Neighbour lists are produced in long form ``(node, nbr, pos)`` with ``pos``
the 0-based position in the ascending list, so a hub with a huge neighbour
list never becomes one row or one task (ranking goes through
:func:`prefix_rank`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .kernel import HOT, prefix_rank, split_hot


def successors(edges: DataFrame) -> DataFrame:
    """G1: ``(node, nbr, pos)`` over out-edges."""
    e = edges.select(F.col("src").alias("node"), F.col("dst").alias("nbr"))
    return prefix_rank(e, ["node"], ["nbr"], out="pos", hot=HOT)


def predecessors(edges: DataFrame) -> DataFrame:
    """``(node, nbr, pos)`` over in-edges."""
    e = edges.select(F.col("dst").alias("node"), F.col("src").alias("nbr"))
    return prefix_rank(e, ["node"], ["nbr"], out="pos", hot=HOT)


def _both_ways(edges: DataFrame) -> DataFrame:
    fwd = edges.select(F.col("src").alias("node"), F.col("dst").alias("nbr"))
    bwd = edges.select(F.col("dst").alias("node"), F.col("src").alias("nbr"))
    return fwd.unionByName(bwd)


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, de-duplicated: ``(node, nbr)``."""
    return _both_ways(edges).distinct()


def adjacent(edges: DataFrame) -> DataFrame:
    """Undirected neighbours ``(node, nbr, pos)``; the rows of a node that is no hub meet once, for both duplicates and positions."""
    cold, hubs = split_hot(_both_ways(edges), ["node"], HOT)
    pos = (F.row_number().over(Window.partitionBy("node").orderBy("nbr")) - 1).cast("bigint")
    ranked = cold.repartition("node").distinct().withColumn("pos", pos)
    return ranked if hubs is None else ranked.unionByName(prefix_rank(hubs.distinct(), ["node"], ["nbr"], out="pos"))


def incident_edges(edges: DataFrame) -> DataFrame:
    """Every edge once per endpoint: ``(node, src, dst, weight, direction)``; a self loop is one "out" row."""
    out_e = edges.select(F.col("src").alias("node"), "src", "dst", "weight", F.lit("out").alias("direction"))
    in_e = edges.where("src <> dst").select(F.col("dst").alias("node"), "src", "dst", "weight", F.lit("in").alias("direction"))
    return out_e.unionByName(in_e)


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(id, in_deg, out_deg, degree)`` for every node (0 when isolated); a self loop counts in both."""
    inc = incident_edges(edges)
    counts = inc.groupBy("node").agg(
        F.count_if((F.col("direction") == "in") | (F.col("src") == F.col("dst"))).alias("in_deg"),
        F.count_if(F.col("direction") == "out").alias("out_deg"))
    res = nodes.select("id").join(counts, nodes["id"] == counts["node"], "left")
    return res.select(
        "id",
        F.coalesce("in_deg", F.lit(0)).cast("bigint").alias("in_deg"),
        F.coalesce("out_deg", F.lit(0)).cast("bigint").alias("out_deg"),
        (F.coalesce("in_deg", F.lit(0)) + F.coalesce("out_deg", F.lit(0))).cast("bigint").alias("degree"))


def has_edge(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of ``pairs (src, dst)`` for which the edge exists (left semi)."""
    return pairs.join(edges.select("src", "dst"), ["src", "dst"], "left_semi")


def edge_cost(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Cost of ``(src, dst)`` in ``edges``; NULL stands for +Infinity."""
    return pairs.join(edges.select("src", "dst", F.col("weight").alias("cost")), ["src", "dst"], "left")


def format_cost(c) -> F.Column:
    """Three decimals, ``-`` for a missing (infinite) cost."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(C.INFINITY_TEXT)).otherwise(F.format_string("%.3f", c))


def init_node(edges: DataFrame) -> DataFrame:
    """The initial state: the smallest source id (one row, ``init_id``)."""
    return edges.agg(F.min("src").alias("init_id"))


def walk_start(edges: DataFrame) -> DataFrame:
    """First successor of the initial node, else the initial node itself.

    One row ``(init_id, start_id)``; both aggregates are partial (map-side).
    """
    init = init_node(edges)
    first = (edges.join(F.broadcast(init), edges["src"] == init["init_id"])  # one row
             .groupBy("init_id").agg(F.min("dst").alias("first_succ")))
    return (init.join(first, "init_id", "left")
            .select("init_id", F.coalesce("first_succ", "init_id").alias("start_id")))


def valuable_nodes(nodes: DataFrame) -> DataFrame:
    """P5: nodes holding valuable data (the predicate reaches the Parquet scan)."""
    return nodes.where(F.col("valuable_data"))


def node_value_match(a: DataFrame, b: DataFrame, how: str = "left_semi") -> DataFrame:
    """G9 by value: rows of ``a`` whose 10 node fields all equal a row of ``b``."""
    from ..schemas import NODE_FIELDS
    cond = [a[c].eqNullSafe(b[c]) for c in NODE_FIELDS]
    return a.join(b, cond, how)


def contained_nodes(a: DataFrame, b: DataFrame, by: str = "value", negate: bool = False) -> DataFrame:
    """Nodes of ``a`` that are in ``b``, by ``id`` or by ``value`` (all fields); with ``negate`` those that are not."""
    how = "left_anti" if negate else "left_semi"
    if by == "value":
        return node_value_match(a, b, how)
    if by != "id":
        raise ValueError(by)
    return a.join(b.select("id"), "id", how)


TILE = 256


def adjacency_tiles(node_ids: DataFrame, edges: DataFrame, tile: int = TILE) -> DataFrame:
    """G8 in tiles: ``(node, row, col_tile, costs)``, the costs from a node to ``tile`` neighbouring columns.

    Columns are the nodes of the subset in ascending order; NULL is no edge (the reference's +Infinity).
    Node numbers come from a skew-safe ranking and meet the edges by joins; a row of the result is one
    tile of one node, so no array is longer than ``tile``. The last tile of a row is as long as is left.
    """
    ids = prefix_rank(node_ids.select(F.col("id").cast("bigint").alias("id")).where("id is not null").distinct(), [], ["id"], out="at")
    n = ids.count()
    i = ids.select(F.col("id").alias("src"), F.col("at").alias("row"))
    j = ids.select(F.col("id").alias("dst"), F.col("at").alias("col"))
    filled = (edges.select("src", "dst", "weight").where("weight is not null").join(i, "src").join(j, "dst")
              .groupBy("row", F.expr(f"col div {tile}").cast("bigint").alias("col_tile"))
              .agg(F.map_from_entries(F.collect_list(F.struct((F.col("col") % tile).cast("int"), "weight"))).alias("m")))
    grid = ids.select(F.col("id").alias("node"), F.col("at").alias("row"),
                      F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(n - 1, 0) // tile).cast("bigint"))).alias("col_tile"))
    width = F.least(F.lit(tile), F.lit(n) - F.col("col_tile") * tile).cast("int")
    at = F.sequence(F.lit(0), width - 1)
    return grid.join(filled, ["row", "col_tile"], "left").select(
        "node", "row", "col_tile", F.transform(at, lambda c: F.when(F.col("m").isNotNull(), F.col("m")[c])).alias("costs"))


def adjacency_dense(node_ids: DataFrame, edges: DataFrame, tile: int = TILE) -> DataFrame:
    """Dense cost rows ``(node, costs)`` over a caller-supplied node subset, put together from tiles.

    ``costs[j]`` is the cost to the j-th node of the subset (ascending ids), NULL for no edge. A row is as
    long as the subset; where that is too long for one value, use :func:`adjacency_tiles`.
    """
    tiles = adjacency_tiles(node_ids, edges, tile)
    rows = tiles.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("col_tile", "costs"))).alias("t"))
    return rows.select("node", F.flatten(F.transform("t", lambda t: t["costs"])).alias("costs"))


def usable_edges(edges: DataFrame) -> DataFrame:
    """Edges a walker may take: finite cost and not a self loop."""
    return edges.where(F.col("weight").isNotNull() & (F.col("src") != F.col("dst")))
