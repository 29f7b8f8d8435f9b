"""Shortest paths on the undirected view of a graph.

The edges are written once as a table in buckets of ``(node, slot)``; a hub's edges
lie in several slots. A round moves its few nodes to the edges and never the edges.

``bfs`` is a multi-source breadth-first search. A level joins the frontier with the
edges and keeps for every newly reached node its smallest-id parent (a partial
``min``). The neighbours of a level lie in the level before, in itself or in the next
one, so new nodes are told from old ones by the last two levels alone and nothing
settled earlier is shuffled again. Each level is written once to the shared
checkpoint folder as a partition ``hops=<level>``.

Rows carry ``(node, parent, target)`` only. :func:`with_paths` rebuilds paths where
they are asked for, by pointer doubling: log2(hops) joins.

``weighted`` adds up edge weights by delta-stepping. Offered distances wait in files by
bucket, a range of distances of one ``width``. The lowest bucket is opened: its nodes
are improved among themselves until none falls, then they are settled and make offers
to later buckets. A node that was settled before lies at most two of the largest
weights below the open bucket, so only these last buckets are looked at.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import scratch_path
from .graph import undirected
from .kernel import Bucketed, cut_lineage

LEVEL = "node bigint, parent bigint, target bigint"
SLOTS = 8  # shares of a node's edges


def _edge_table(ways: DataFrame) -> Bucketed:
    """``(node, slot, nbr, ...)`` in buckets."""
    return Bucketed(ways.withColumn("slot", F.pmod(F.xxhash64("nbr"), F.lit(SLOTS)).cast("int")), ["node", "slot"])


def _meet(frontier: DataFrame, edges: Bucketed) -> DataFrame:
    """The edges of the nodes of ``frontier`` (column ``node``).

    The frontier, ``SLOTS`` rows a node, is exchanged and hashed; never broadcast, which would gather it on the driver.
    """
    asked = frontier.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    return asked.hint("shuffle_hash").join(edges.table(), ["node", "slot"]).drop("slot")


def bfs(sources: DataFrame, edges: DataFrame, max_levels: int | None = None) -> DataFrame:
    """Rows ``(node, hops, target, parent)`` for every node reachable from ``sources``.

    ``sources`` has one column ``node``. ``target`` is the source the path
    ends at; ``parent`` is the smallest-id neighbour one level closer.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, f"bfs-{uuid.uuid4().hex}")

    def settle(rows: DataFrame, level: int) -> DataFrame:
        rows.write.parquet(f"{root}/hops={level}")
        return spark.read.schema(LEVEL).parquet(f"{root}/hops={level}")

    start = sources.where("node is not null").select("node").distinct()
    frontier = settle(start.select("node", F.lit(None).cast("bigint").alias("parent"), F.col("node").alias("target")), 0)
    previous, level = None, 0
    with _edge_table(undirected(edges)) as und:
        while max_levels is None or level < max_levels:
            level += 1
            known = frontier if previous is None else frontier.unionByName(previous)
            reach = (_meet(frontier.select("node", "target"), und)
                     .groupBy(F.col("nbr")).agg(F.min(F.struct(F.col("node").alias("parent"), "target")).alias("via"))
                     .withColumnRenamed("nbr", "node"))
            fresh = reach.join(known.select("node").hint("merge"), "node", "left_anti").select("node", "via.parent", "via.target")
            previous, frontier = frontier, settle(fresh, level)
            if frontier.isEmpty():
                break
    return spark.read.schema(f"{LEVEL}, hops bigint").parquet(root).select("node", "hops", "target", "parent")


def with_paths(reached: DataFrame) -> DataFrame:
    """``reached`` (from :func:`bfs`) plus ``path``, the nodes from ``node`` to ``target``.

    Every round appends to the known part of a path the part known at its end, so
    parts double in length.
    """
    longest = reached.agg(F.max("hops")).first()[0] or 0
    paths = reached.select("node", F.array("node").alias("path"), F.col("parent").alias("next"))
    for _ in range(longest.bit_length()):
        paths = cut_lineage(paths)
        ahead = paths.select(F.col("node").alias("_at"), F.col("path").alias("_more"), F.col("next").alias("_next"))
        paths = paths.join(ahead.hint("merge"), F.col("next") == F.col("_at"), "left").select(
            "node", F.when(F.col("_at").isNull(), F.col("path")).otherwise(F.concat("path", "_more")).alias("path"),
            F.col("_next").alias("next"))
    return reached.join(paths.select("node", "path").hint("merge"), "node")


def _valuable(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("valuable_data")).select(F.col("id").alias("node"))


def nearest_valuable(nodes: DataFrame, edges: DataFrame, paths: bool = False) -> DataFrame:
    """D1/D3/D5 for every node: hops and distance to the nearest valuable node, with ``path`` if asked for.

    Every hop costs the stored value of the node itself (M6 prices it with the
    thief's). Unreachable nodes get ``hops = 2147483647``, NULL target / distance
    and an empty path.
    """
    reached = bfs(_valuable(nodes), edges)
    if paths:
        reached = with_paths(reached)
    res = nodes.select("id", "stored_value").join(reached.withColumnRenamed("node", "id").hint("merge"), "id", "left")
    cols = ["id", F.coalesce("hops", F.lit(C.UNREACHABLE).cast("bigint")).alias("hops"), "target",
            (F.col("hops").cast("double") * F.col("stored_value")).alias("distance")]
    if paths:
        cols.append(F.coalesce(F.array_join(F.col("path").cast("array<string>"), ","), F.lit("")).alias("path"))
    return res.select(*cols)


def weighted(sources: DataFrame, edges: DataFrame, width: float | None = None) -> DataFrame:
    """D1 by edge weights: ``(node, distance, target)``, the least sum of weights to a source.

    Edges go both ways at the smaller of their two weights; those without a weight
    cannot be taken, and a negative one is an error. Equal distances: smallest target.
    ``width`` is the range of distances of a bucket, by default the mean weight.
    """
    spark = edges.sparkSession
    both = (edges.select(F.col("src").alias("node"), F.col("dst").alias("nbr"), "weight")
            .unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("nbr"), "weight")))
    ways = both.where("weight is not null and node <> nbr").groupBy("node", "nbr").agg(F.min("weight").alias("weight"))
    root = scratch_path(spark, f"weighted-{uuid.uuid4().hex}")
    offer = "node bigint, distance double, target bigint"
    waiting: dict[int, list[str]] = {}   # bucket -> folders with offers to it
    settled: dict[int, DataFrame] = {}

    def least(offers: DataFrame) -> DataFrame:
        best = offers.groupBy("node").agg(F.min(F.struct("distance", "target")).alias("at"))
        return best.select("node", "at.distance", "at.target")

    def unsettled(offers: DataFrame, k: int) -> DataFrame:
        """``offers`` to nodes that no bucket near ``k`` has settled, by one join; nothing is broadcast."""
        near = [settled[j].select("node") for j in settled if j >= k - back]
        return offers.join(reduce(DataFrame.unionByName, near).hint("merge"), "node", "left_anti") if near else offers

    def reach(rows: DataFrame, table: Bucketed) -> DataFrame:
        return least(_meet(rows, table).select(F.col("nbr").alias("node"), (F.col("distance") + F.col("weight")).alias("distance"), "target"))

    with _edge_table(ways) as table:
        low, high, mean = table.table().agg(F.min("weight"), F.max("weight"), F.avg("weight")).first()
        if low is not None and low < 0:
            raise ValueError("negative edge weight")
        high = high or 0.0
        width = width or mean or 1.0
        back = math.ceil(2 * high / width) + 1
        start = sources.where("node is not null").select("node").distinct()
        first = f"{root}/offers-start"
        start.select("node", F.lit(0.0).alias("distance"), F.col("node").alias("target")).write.parquet(f"{first}/bucket=0")
        waiting[0] = [first]
        while waiting:
            k = min(waiting)
            offers = spark.read.schema(offer).parquet(*[f"{path}/bucket={k}" for path in waiting.pop(k)])
            open_rows = cut_lineage(unsettled(least(offers), k))
            fell = open_rows
            while low is not None and low < width and not fell.isEmpty():
                inside = unsettled(reach(fell, table).where(F.col("distance") < (k + 1) * width), k)
                new = F.struct(F.col("distance2").alias("distance"), F.col("target2").alias("target"))
                better = F.col("distance2").isNotNull() & (F.col("distance").isNull() | (new < F.struct("distance", "target")))
                met = open_rows.join(inside.select("node", F.col("distance").alias("distance2"), F.col("target").alias("target2")),
                                     "node", "full_outer")
                met = cut_lineage(met.select("node", F.when(better, F.col("distance2")).otherwise(F.col("distance")).alias("distance"),
                                             F.when(better, F.col("target2")).otherwise(F.col("target")).alias("target"), better.alias("fell")))
                open_rows, fell = met.drop("fell"), met.where("fell").drop("fell")
            open_rows.write.parquet(f"{root}/settled/bucket={k}")
            settled[k] = spark.read.schema(offer).parquet(f"{root}/settled/bucket={k}")
            path = f"{root}/offers-{k}"
            later = reach(settled[k], table).withColumn("bucket", F.floor(F.col("distance") / width)).where(F.col("bucket") > k)
            later.write.partitionBy("bucket").parquet(path)
            # at most one more than the largest weight has widths
            for r in spark.read.schema(f"{offer}, bucket bigint").parquet(path).select("bucket").distinct().collect():
                waiting.setdefault(r["bucket"], []).append(path)
    return spark.read.schema(f"{offer}, bucket bigint").parquet(f"{root}/settled").select("node", "distance", "target")


def nearest_valuable_weighted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """D1 by edge weights for every node: ``(id, target, distance)``, NULL when unreachable."""
    reached = weighted(_valuable(nodes), edges)
    return nodes.select("id").join(reached.withColumnRenamed("node", "id").hint("merge"), "id", "left").select("id", "target", "distance")


def single_source_hops(source: DataFrame, edges: DataFrame) -> DataFrame:
    """Hops from one node (column ``node``) to every reachable node."""
    return bfs(source, edges).select("node", "hops")
