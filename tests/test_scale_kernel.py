"""Ranks, running sums and next rows with large groups apart equal plain windows; small groups are not written first."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from twingraph import fixtures as fx
from twingraph.operators import graph, kernel


def _data(spark):
    g = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 97 == 5, None).otherwise(F.col("id") % 97)
    return spark.range(0, 9000).select(g.alias("g"), ((F.col("id") * 7919) % 100003).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") % 5).alias("v"))


@pytest.mark.parametrize("hot", [50, 1000, 10**6])
def test_large_groups_apart_equal_windows(spark, hot):
    df, w = _data(spark), Window.partitionBy("g").orderBy("k")
    want = df.select("g", "k", "v", (F.row_number().over(w) - 1).cast("bigint").alias("rn"), F.lead("v").over(w).alias("nv"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    got = [(kernel.prefix_rank(df, ["g"], ["k"], out="rn", hot=hot), "rn"), (kernel.with_next(df, ["g"], ["k"], "v", "nv", hot=hot), "nv"),
           (kernel.prefix_sum(df, ["g"], ["k"], {"s": "v"}, hot=hot), "s")]
    for rows, out in got:
        assert rows.count() == 9000
        assert rows.select("g", "k", "v", out).exceptAll(want.select("g", "k", "v", out)).count() == 0


def test_hubs_among_neighbours(spark, monkeypatch):
    e = spark.range(600).selectExpr("id % 2 as src", "id % 150 as dst", "cast(1 as double) as weight").unionByName(
        spark.range(90).selectExpr("id as src", "id + 1 as dst", "cast(1 as double) as weight"))
    plain = sorted(map(tuple, graph.adjacent(e).collect()))
    monkeypatch.setattr(graph, "HOT", 20)
    assert sorted(map(tuple, graph.adjacent(e).collect())) == plain
    assert len(plain) == graph.undirected(e).count()


def test_small_groups_are_exchanged_once(spark):
    e = spark.range(60).selectExpr("id % 7 as src", "id as dst", "cast(1 as double) as weight")
    plan = graph.successors(e)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "cut-" not in plan


def test_edges_exchange_no_price(spark, tmp_dir):
    """Lines alike but for the price follow one another in any order: same edges, and the price stays out of the exchange."""
    rows = [(o, 1 + (o + n // 3) % 5, n // 2, None if n % 7 == 6 else float(n // 6), float((n * 37 + o) % 11)) for o in range(20) for n in range(24)]
    lines = spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double")
    lines.write.parquet(f"{tmp_dir}/lineitem.parquet")
    edges = fx.original_edges(spark, tmp_dir)
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    src, dst = F.col("src"), F.col("dst")
    want = (lines.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"), "l_quantity").where("dst is not null")
            .groupBy("src", "dst").agg(F.min(F.col("l_quantity").cast("bigint") % 9 + 1).cast("double").alias("weight"))
            .select("src", "dst", F.when((src * 31 + dst) % 50 != 7, F.col("weight")).alias("weight")))
    assert edges.count() == want.count() > 0
    assert edges.exceptAll(want).count() == 0
    assert "l_extendedprice" not in edges._jdf.queryExecution().executedPlan().toString()
