"""Ranking, running sums and next rows equal plain windows, whatever the groups look like."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from twingraph.operators.kernel import _sliced, prefix_rank, prefix_sum, with_next


def _data(spark):
    # group 0 holds a third of the rows, group null a few hundred
    g = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 97 == 5, None).otherwise(F.col("id") % 97)
    return spark.range(0, 30000).select(g.alias("g"), ((F.col("id") * 7919) % 100003).alias("k"), (F.col("id") % 5).alias("v"),
                                        F.concat(F.lit("s"), F.lpad(((F.col("id") * 7919) % 100003).cast("string"), 6, "0")).alias("t"))


@pytest.mark.parametrize("partitions", [None, 1, 7, 32])
@pytest.mark.parametrize("order", ["k", "t"])
def test_prefix_rank_equals_window(spark, partitions, order):
    df = _data(spark)
    got = prefix_rank(df, ["g"], [order], out="rn", partitions=partitions)
    exp = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(order)) - 1)
    assert got.count() == df.count()
    assert got.select("g", "k", "rn").exceptAll(exp.select("g", "k", "rn")).count() == 0


def test_prefix_rank_global(spark):
    df = _data(spark).select("k").distinct()
    got = prefix_rank(df, [], ["k"], out="rn", partitions=16)
    assert got.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first() == (0, df.count() - 1, df.count())
    w = got.withColumn("prev", F.lag("rn").over(Window.orderBy("k")))
    assert w.where("prev is not null and rn <> prev + 1").count() == 0


@pytest.mark.parametrize("partitions", [1, 9])
def test_prefix_sum_matches_window(spark, partitions):
    df = _data(spark).withColumn("v", F.when(F.col("k") % 4 > 0, F.col("v")))
    got = prefix_sum(df, ["g"], ["k"], {"s": "v"}, partitions=partitions)
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("s", F.sum("v").over(w))
    assert got.count() == df.count()
    assert got.select("g", "k", "s").exceptAll(exp.select("g", "k", "s")).count() == 0


@pytest.mark.parametrize("partitions", [1, 9])
def test_with_next_equals_lead(spark, partitions):
    df = _data(spark).withColumn("v", F.when(F.col("k") % 4 > 0, F.col("v")))
    got = with_next(df, ["g"], ["k"], "v", "nv", partitions=partitions)
    exp = df.withColumn("nv", F.lead("v").over(Window.partitionBy("g").orderBy("k")))
    assert got.count() == df.count()
    assert got.select("g", "k", "v", "nv").exceptAll(exp.select("g", "k", "v", "nv")).count() == 0


def test_hot_group_and_many_hot_groups_spread(spark):
    """One hub spreads over several slices, and so does each of ten large groups."""
    hub = _sliced(_data(spark), ["g"], ["k"], 16).where("g = 0")
    assert hub.select("_slice").distinct().count() >= 4
    many = spark.range(0, 40000).select((F.col("id") % 10).alias("g"), F.col("id").alias("k"))
    per = _sliced(many, ["g"], ["k"], 40).groupBy("g").agg(F.countDistinct("_slice").alias("n"))
    assert per.agg(F.min("n")).first()[0] >= 3


def test_rows_never_meet_in_one_partition(spark):
    """Only the totals of the slices may be gathered in one partition."""
    plan = prefix_rank(_data(spark), [], ["k"], out="rn", partitions=16)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1] and "_n#" in lines[i + 1], lines[i + 1]
