"""Graph sources (S1-S3): Parquet graph pairs, DOT edge lists, perturbation reports.

All readers take globs, so many files are read in parallel; parsing is
column expressions over ``spark.read.text``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EDGE, NODE

_DOT_EDGE = r'^\s*"(-?\d+)"\s*->\s*"(-?\d+)"\s*(?:\[.*\])?\s*;?\s*$'
_DOT_WEIGHT = r'[\[,]\s*"weight"\s*=\s*"([^"]+)"'
_DOT_NODE = r'^\s*"(-?\d+)"\s*(?:\[.*\])?\s*;?\s*$'


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(nodes, edges)`` from ``<path>/nodes`` and ``<path>/edges`` Parquet with fixed schemas.

    Raises when either side is empty (the reference exits when a graph fails to load).
    """
    nodes = spark.read.schema(NODE).parquet(f"{path.rstrip('/')}/nodes")
    edges = spark.read.schema(EDGE).parquet(f"{path.rstrip('/')}/edges")
    for name, side in (("nodes", nodes), ("edges", edges)):
        if side.isEmpty():
            raise ValueError(f"no {name} under {path}")
    return nodes, edges


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.select(*NODE.fieldNames()).write.mode("overwrite").parquet(f"{path.rstrip('/')}/nodes")
    edges.select(*EDGE.fieldNames()).write.mode("overwrite").parquet(f"{path.rstrip('/')}/edges")


def read_dot(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """``(edges, nodes)`` from DOT files.

    edges: ``(src, dst, weight, file)``; nodes: ``(id, file)`` for every id
    declared alone (isolated or attributed nodes) or used by an edge. An edge
    without a readable weight has a null one; see :func:`dot_rejects` for statements
    that are neither.
    """
    lines = spark.read.text(glob).select(F.col("value").alias("line"), F.input_file_name().alias("file"))
    e = lines.where(F.col("line").rlike(_DOT_EDGE)).select(
        F.regexp_extract("line", _DOT_EDGE, 1).cast("bigint").alias("src"),
        F.regexp_extract("line", _DOT_EDGE, 2).cast("bigint").alias("dst"),
        F.regexp_extract("line", _DOT_WEIGHT, 1).try_cast("double").alias("weight"),
        "file")
    decl = lines.where(F.col("line").rlike(_DOT_NODE)).select(
        F.regexp_extract("line", _DOT_NODE, 1).cast("bigint").alias("id"), "file")
    ends = e.select(F.col("src").alias("id"), "file").unionByName(e.select(F.col("dst").alias("id"), "file"))
    return e, decl.unionByName(ends).distinct()


def dot_rejects(spark: SparkSession, glob: str) -> DataFrame:
    """``(line, file)`` of statements that :func:`read_dot` cannot read, such as ids that are no integers."""
    lines = spark.read.text(glob).select(F.col("value").alias("line"), F.input_file_name().alias("file"))
    statement = F.col("line").rlike(r'^\s*("|-?\w+\s*->)')
    return lines.where(statement & ~F.col("line").rlike(_DOT_EDGE) & ~F.col("line").rlike(_DOT_NODE))


def edges_to_dot(edges: DataFrame) -> DataFrame:
    """DOT statement lines for edges (column ``value``)."""
    return edges.select(F.format_string('"%d" -> "%d" ["weight"="%s"]', "src", "dst",
                                        F.col("weight").cast("string")).alias("value"))


def nodes_to_dot(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.format_string('"%d"', "id").alias("value"))


def carried_lines(spark: SparkSession, glob: str, headers: dict[str, Column]) -> DataFrame:
    """Lines of text files with the last header before each of them: ``(file, block, pos, line, <headers>)``.

    ``headers`` are expressions over ``line`` that are null on other lines. A file is read in splits;
    ``block`` is where a split begins. Inside a split the header is carried by a window over its lines;
    what a split inherits is carried over the splits of its file, of which there is one row each.
    """
    lines = spark.read.text(glob).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    lines = lines.select("*", *[c.alias(n) for n, c in headers.items()])
    last = lines.groupBy("file", "block").agg(*[F.max_by(F.when(F.col(n).isNotNull(), F.col(n)), F.when(F.col(n).isNotNull(), F.col("pos"))).alias(f"_{n}")
                                                for n in headers])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = last.select("file", "block", *[F.last(f"_{n}", ignorenulls=True).over(earlier).alias(f"_{n}") for n in headers])
    within = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    tagged = lines.select("file", "block", "pos", "line", *[F.last(n, ignorenulls=True).over(within).alias(n) for n in headers])
    return tagged.join(inherited, ["file", "block"]).select(
        "file", "block", "pos", "line", *[F.coalesce(n, f"_{n}").alias(n) for n in headers])


def read_delta(spark: SparkSession, glob: str) -> DataFrame:
    """S3: perturbation report(s) as DELTA rows ``(entity, change, a, b, file)``.

    The report is an operation log with sections ``Nodes:``/``Edges:`` and
    sub-sections ``Modified``/``Removed``/``Added``; node lists are inline
    ``[a, b, ...]``, pairs are ``a: b`` lines (keys may repeat). A large file is
    read by several tasks; the section headers are carried over its splits.
    """
    ent = F.nullif(F.regexp_extract("line", r"^(Nodes|Edges):\s*$", 1), F.lit(""))
    chg = F.nullif(F.regexp_extract("line", r"^\s+(Modified|Removed|Added):", 1), F.lit(""))
    tagged = carried_lines(spark, glob, {"entity": ent, "change": chg})
    inline = (tagged.where(F.col("line").rlike(r"^\s+(Modified|Removed|Added):\s*\[.*\]"))
              .select("file", "entity", "change",
                      F.explode(F.split(F.regexp_extract("line", r"\[(.*)\]", 1), ",")).alias("x"))
              .where(F.trim("x") != "")
              .select("entity", "change", F.trim("x").cast("bigint").alias("a"),
                      F.lit(None).cast("bigint").alias("b"), "file"))
    pair_re = r"^\s+(-?\d+)\s*:\s*(-?\d+)\s*$"
    pairs = tagged.where(F.col("line").rlike(pair_re)).select(
        "entity", "change",
        F.regexp_extract("line", pair_re, 1).cast("bigint").alias("a"),
        F.regexp_extract("line", pair_re, 2).cast("bigint").alias("b"), "file")
    return inline.unionByName(pairs)


SHARD_MARK = "#shard="


def read_shards(spark: SparkSession, path: str, schema: T.StructType | str, shards: list[int] | None = None) -> DataFrame:
    """K4 read back: rows of packed shards with ``shard_id``; with ``shards`` only these."""
    mark = F.regexp_extract("line", f"^{SHARD_MARK}(\\d+),", 1).try_cast("bigint")
    rows = carried_lines(spark, path, {"shard_id": mark}).where(~F.col("line").startswith(SHARD_MARK))
    if shards is not None:
        rows = rows.where(F.col("shard_id").isin(shards))
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select("shard_id", F.from_csv("line", ddl).alias("r")).select("shard_id", "r.*")
