"""Connected components of a link table, as joins and grouped minima.

Every round replaces each link by links to the smallest neighbour, first among
larger, then among smaller nodes (alternating large-star and small-star steps),
until nothing changes. A hub's rows meet partial minima before the shuffle and a
splittable join after it; no component is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest of the node and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and the node, go to the smallest of them."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    return (links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct())


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)`` for each node of a link: the smallest node that it reaches.

    Self links and repeated links are allowed; nulls are ignored. Nodes without a
    link to another node do not appear.
    """
    spark = links.sparkSession
    start = (links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
             .where("u <> v").distinct())
    now, path = materialise(start, "links")
    seen = None
    while True:
        check = now.agg(F.count(F.lit(1)).alias("n"),
                        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if check["n"] == 0 or (check["n"], check["h"]) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select("v", "v").distinct().toDF("node", "component"))
        seen = (check["n"], check["h"])
        nxt, nxt_path = materialise(_small_star(_large_star(now)), "links")
        drop_path(spark, path)
        now, path = nxt, nxt_path
