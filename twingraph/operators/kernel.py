"""Shared DataFrame algorithms: skew-safe ranking and lineage cuts.

``prefix_rank``, ``prefix_sum`` and ``with_next`` are safe for groups of any size. Rows
are range-partitioned by (group, all order columns), so a group of any size spreads
over as many slices as its rows need, and are written once with their slice number.
Each (slice, group) is numbered on its own. Only the first group of a slice can go on
from an earlier slice, so at most one row per slice carries what came before; these
few rows are broadcast. Any sortable type works, and null is a group like any other.

That writes every row and exchanges it twice. With ``hot`` rows are first counted in
``BINS`` hash bins of their groups; bins of at most ``hot`` rows cannot hold a larger
group and are ordered by a plain window, one exchange; only the others are sliced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_path, scratch_path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Survives executor loss, unlike a local checkpoint or a cache, and later reads
    still prune columns and push filters down.
    """
    path = scratch_path(df.sparkSession, f"cut-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Bucketed:
    """``df`` written as a table in buckets of ``keys``, in the shared folder.

    A join on exactly these keys reads the table where it lies: only the other side is exchanged.
    As a context manager it drops the table and its files at the end.
    """

    def __init__(self, df: DataFrame, keys: list[str], buckets: int | None = None):
        self.spark = df.sparkSession
        buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"bucketed_{uuid.uuid4().hex}"
        self.path = scratch_path(self.spark, self.name)
        # dealt by the same hash as the buckets, so a bucket is one sorted file
        (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
         .option("path", self.path).saveAsTable(self.name))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def __enter__(self) -> Bucketed:
        return self

    def __exit__(self, *exc) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_path(self.spark, self.path)


def _sliced(df: DataFrame, groups: list[str], order_cols: list[str], partitions: int | None) -> DataFrame:
    """Rows with ``_slice``, the number of their range of (group, order columns).

    The written copy fixes the slices: every later read sees the same ones, whatever
    is recomputed.
    """
    keys = [F.col(c) for c in [*groups, *order_cols]]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))


def _meet(rows: DataFrame, few: DataFrame, groups: list[str]) -> DataFrame:
    """Left join on slice and group; ``few`` has at most one row per slice."""
    named = few.select(F.col("_slice").alias("_s"), *[F.col(g).alias(f"_g_{g}") for g in groups],
                       *[c for c in few.columns if c not in ("_slice", *groups)])
    on = [rows["_slice"] == named["_s"], *[rows[g].eqNullSafe(named[f"_g_{g}"]) for g in groups]]
    return rows.join(F.broadcast(named), on, "left").drop("_s", *[f"_g_{g}" for g in groups])


def _earlier(groups: list[str]):
    """Window over the slices of a group before the present one."""
    w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return w.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


BINS = 1 << 16  # hash bins in which groups are counted
HOT = 500_000  # rows of a bin that a plain window may order in one task


def split_hot(df: DataFrame, groups: list[str], hot: int = HOT) -> tuple[DataFrame, DataFrame | None]:
    """``df`` without the hash bins of groups that have more than ``hot`` rows, and the rows of these (None: there are none).

    A group lies wholly in one part. The counts of a task are at most ``BINS`` rows; at most one bin per ``hot`` rows is collected.
    """
    at = F.pmod(F.xxhash64(*groups), F.lit(BINS))
    large = [r["_bin"] for r in df.groupBy(at.alias("_bin")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).collect()]
    return (df.where(~at.isin(large)), df.where(at.isin(large))) if large else (df, None)


def _by_size(df: DataFrame, groups: list[str], hot: int, plain, sliced) -> DataFrame:
    """``plain`` of the rows in small bins and ``sliced`` of the others."""
    cold, large = split_hot(df, groups, hot)
    return plain(cold) if large is None else plain(cold).unionByName(sliced(large))


def prefix_rank(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str = "rn",
                partitions: int | None = None, hot: int | None = None) -> DataFrame:
    """Add ``out``: 0-based position of each row inside its group.

    ``group_cols + order_cols`` must identify a row for the numbers to be unique in
    meaning; ties are numbered in any order.
    """
    groups = list(group_cols)
    if hot and groups:
        local = F.row_number().over(Window.partitionBy(*groups).orderBy(*order_cols)) - 1
        return _by_size(df, groups, hot, lambda rows: rows.withColumn(out, local.cast("bigint")),
                        lambda rows: prefix_rank(rows, groups, order_cols, out, partitions))
    rows = _sliced(df, groups, order_cols, partitions)
    local = F.row_number().over(Window.partitionBy("_slice", *groups).orderBy(*order_cols)) - 1
    totals = rows.groupBy("_slice", *groups).agg(F.count(F.lit(1)).alias("_n"))
    before = totals.select("_slice", *groups, F.sum("_n").over(_earlier(groups)).alias("_off")).where("_off > 0")
    joined = _meet(rows.withColumn("_lr", local), before, groups)
    return joined.withColumn(out, (F.col("_lr") + F.coalesce("_off", F.lit(0))).cast("bigint")).drop("_slice", "_lr", "_off")


def prefix_sum(df: DataFrame, group_cols: list[str], order_cols: list[str], value_cols: dict[str, Column | str],
               partitions: int | None = None, hot: int | None = None) -> DataFrame:
    """Running (inclusive) sums of ``value_cols`` inside each group; null values add nothing."""
    groups = list(group_cols)
    if hot and groups:
        w = Window.partitionBy(*groups).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        sums = {k: F.sum(v).over(w) for k, v in value_cols.items()}
        return _by_size(df, groups, hot, lambda rows: rows.select("*", *[c.alias(k) for k, c in sums.items()]),
                        lambda rows: prefix_sum(rows, groups, order_cols, value_cols, partitions))
    for k, v in value_cols.items():
        df = df.withColumn(f"_v_{k}", F.col(v) if isinstance(v, str) else v)
    rows = _sliced(df, groups, order_cols, partitions)
    frame = (Window.partitionBy("_slice", *groups).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, 0))
    totals = rows.groupBy("_slice", *groups).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in value_cols])
    before = totals.select("_slice", *groups, F.count(F.lit(1)).over(_earlier(groups)).alias("_b"),
                           *[F.sum(f"_t_{k}").over(_earlier(groups)).alias(f"_o_{k}") for k in value_cols]).where("_b > 0")
    for k in value_cols:
        rows = rows.withColumn(f"_l_{k}", F.sum(f"_v_{k}").over(frame))
    joined = _meet(rows, before, groups)
    for k in value_cols:
        joined = joined.withColumn(k, F.coalesce(F.col(f"_l_{k}") + F.col(f"_o_{k}"), f"_l_{k}", f"_o_{k}"))
    return joined.drop("_slice", "_b", *[f"{p}{k}" for k in value_cols for p in ("_v_", "_l_", "_o_")])


def with_next(df: DataFrame, group_cols: list[str], order_cols: list[str], value_col: str, out: str,
              partitions: int | None = None, hot: int | None = None) -> DataFrame:
    """Add ``out``: ``value_col`` of the next row of the group in ``order_cols`` order, else null."""
    groups = list(group_cols)
    if hot and groups:
        following = F.lead(value_col).over(Window.partitionBy(*groups).orderBy(*order_cols))
        return _by_size(df, groups, hot, lambda rows: rows.withColumn(out, following),
                        lambda rows: with_next(rows, groups, order_cols, value_col, out, partitions))
    rows = _sliced(df, groups, order_cols, partitions)
    w = Window.partitionBy("_slice", *groups).orderBy(*order_cols)
    firsts = rows.groupBy("_slice", *groups).agg(
        F.min(F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order_cols)], F.col(value_col).alias("_v"))).alias("_f"))
    following = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_slice")
    after = (firsts.select("_slice", *groups, F.lead("_f").over(following).alias("_f")).where("_f is not null")
             .select("_slice", *groups, F.col("_f._v").alias("_after")))
    local = rows.withColumn("_lead", F.lead(value_col).over(w)).withColumn("_more", F.lead(F.lit(True)).over(w))
    joined = _meet(local, after, groups)
    return (joined.withColumn(out, F.when(F.col("_more"), F.col("_lead")).otherwise(F.col("_after")))
            .drop("_slice", "_lead", "_more", "_after"))


FINER = 1024  # parts into which a pass of :func:`select_ranks` cuts a range


def select_ranks(df: DataFrame, value: str, ranks: list[int]) -> list[int | None]:
    """The values at 0-based ``ranks`` of the ascending whole numbers in column ``value``.

    Each pass counts the rows of ``FINER`` equal parts of a range and goes on in the part that holds the
    rank, until that part is one value: at most seven passes, whose only state is the counts of the parts.
    Nulls have no rank; a rank beyond the last row gives None.
    """
    rows = cut_lineage(df.select(F.col(value).cast("bigint").alias("v")).where("v is not null"))
    low, high, n = rows.agg(F.min("v"), F.max("v"), F.count("v")).first()
    out: list[int | None] = []
    for rank in ranks:
        if not 0 <= rank < n:
            out.append(None)
            continue
        a, z, before = low, high, 0
        while a < z:
            step = -(-(z - a + 1) // FINER)
            inside = rows.where(F.col("v").between(a, z))
            part = F.expr(f"cast((cast(v as decimal(20,0)) - cast('{a}' as decimal(20,0))) div cast('{step}' as decimal(20,0)) as int)")
            counts = dict(inside.groupBy(part.alias("part")).count().collect())  # at most FINER rows
            for i in range(FINER):
                if before + counts.get(i, 0) > rank:
                    break
                before += counts.get(i, 0)
            a, z = a + i * step, min(z, a + (i + 1) * step - 1)
        out.append(a)
    return out
