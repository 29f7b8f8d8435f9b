"""Sinks (K1-K10). Partitioned writes; a single file only when asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.kernel import prefix_rank
from ..schemas import NODE_FIELDS

PAIR18 = [f"{s}_{c}" for s in ("o", "p") for c in NODE_FIELDS[:9]]
EDGE_PAIR6 = ["o_src", "o_dst", "o_weight", "p_src", "p_dst", "p_weight"]
REPORT_CHUNK = 1000
SHARDS_PER_FILE = 50_000


def write_nodes_csv(nodes: DataFrame, path: str) -> None:
    """K1: bare node property lines, no header."""
    nodes.select(*NODE_FIELDS).write.mode("overwrite").csv(path)


def write_node_pairs_csv(pairs: DataFrame, path: str) -> None:
    """K2: 18 columns (9 + 9, no valuable flag) with a header."""
    pairs.select(*PAIR18).write.mode("overwrite").option("header", True).csv(path)


def write_edge_pairs_csv(edge_pairs: DataFrame, path: str) -> None:
    """K3: 6 columns ``o_src, o_dst, o_weight, p_src, p_dst, p_weight``."""
    ep = edge_pairs.select(
        F.when(F.col("in_o"), F.col("src")).alias("o_src"), F.when(F.col("in_o"), F.col("dst")).alias("o_dst"), "o_weight",
        F.when(F.col("in_p"), F.col("src")).alias("p_src"), F.when(F.col("in_p"), F.col("dst")).alias("p_dst"), "p_weight")
    ep.write.mode("overwrite").option("header", True).csv(path)


def write_combined_pairs(pairs: DataFrame, path: str, header: bool = False) -> None:
    """K6: node pairs that exist already (by id, or the candidates of a join) as 20-column lines, bare by default."""
    pairs.select(*[f"{s}_{c}" for s in ("o", "p") for c in NODE_FIELDS]).write.mode("overwrite").option("header", header).csv(path)


def shard(df: DataFrame, order_cols: list[str], size: int = C.SHARD_SIZE) -> DataFrame:
    """K4: consecutive shards of ``size`` rows in ``order_cols`` order.

    Adds ``shard_id`` and ``row_in_shard`` from a skew-safe global row number
    (no single-partition window).
    """
    r = prefix_rank(df, [], order_cols, out="_rn")
    return (r.withColumn("shard_id", (F.col("_rn") / F.lit(size)).cast("bigint"))
            .withColumn("row_in_shard", (F.col("_rn") % size).cast("bigint")).drop("_rn"))


def write_shards(sharded: DataFrame, path: str, per_file: int = SHARDS_PER_FILE) -> None:
    """K4 sink: whole shards one after the other, at most ``per_file`` of them in a text file.

    A shard is its header line ``#shard=<id>,<columns>`` and then its rows as quoted CSV, so a row never
    looks like a header; values must not hold line breaks. :func:`readers.read_shards` reads them back.
    """
    columns = [c for c in sharded.columns if c not in ("shard_id", "row_in_shard")]
    line = F.to_csv(F.struct(*columns), {"quoteAll": "true"})
    packed = sharded.groupBy("shard_id").agg(F.sort_array(F.collect_list(F.struct("row_in_shard", line.alias("line")))).alias("rows"))
    head = F.concat(F.lit("#shard="), F.col("shard_id").cast("string"), F.lit("," + ",".join(columns) + "\n"))
    text = packed.sort("shard_id").select(F.concat(head, F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("value"))
    text.write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path)


def extract_formatted(nodes: DataFrame, edges: DataFrame, cost_graph: DataFrame,
                      group: int = C.EXTRACT_GROUP) -> DataFrame:
    """K5 + P9: nodes and edges in groups of ``group`` as text lines.

    Nodes print their fields with the stored value as ``%.3f``; edges print
    ``src,dst,cost`` with the cost looked up in ``cost_graph`` (``-`` when
    absent). Every edge group is written (the reference drops edge groups
    past the last node group).
    """
    from ..operators.graph import edge_cost, format_cost
    n = shard(nodes, ["id"], group).select(
        F.lit("node").alias("kind"), F.col("shard_id").alias("group_id"), F.col("row_in_shard").alias("pos"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in NODE_FIELDS[:8]],
                    F.format_string("%.3f", "stored_value"), F.col("valuable_data").cast("string")).alias("line"))
    costed = edge_cost(edges.select("src", "dst"), cost_graph)
    e = shard(costed, ["src", "dst"], group).select(
        F.lit("edge").alias("kind"), F.col("shard_id").alias("group_id"), F.col("row_in_shard").alias("pos"),
        F.concat_ws(",", F.col("src").cast("string"), F.col("dst").cast("string"), format_cost("cost")).alias("line"))
    return n.unionByName(e)


def write_text(lines: DataFrame, path: str, single_file: bool = False) -> None:
    """K7-K9: text sink, partitioned unless a single file is requested."""
    out = lines.coalesce(1) if single_file else lines
    out.write.mode("overwrite").text(path)


def write_status_json(status: DataFrame, path: str) -> None:
    """One nested JSON document per player."""
    doc = status.select(
        "game_id", "role",
        F.struct("node", "adjacent", "hops", "distance", "path", "confidence", "n_moves").alias("status"))
    doc.write.mode("overwrite").json(path)


def delta_report_docs(delta: DataFrame, chunk: int = REPORT_CHUNK) -> DataFrame:
    """Render DELTA rows as report text in bounded, self-contained chunks.

    Every output row is a small report (entity header, change header, at
    most ``chunk`` entries), so no section is ever gathered in one task.
    """
    d = delta.withColumn("_chunk", (F.col("a") / F.lit(chunk)).cast("bigint"))
    listed = d.where((F.col("entity") == "Nodes") & F.col("change").isin("Modified", "Removed"))
    paired = d.where(~((F.col("entity") == "Nodes") & F.col("change").isin("Modified", "Removed")))
    lists = listed.groupBy("entity", "change", "_chunk").agg(
        F.concat(F.col("entity"), F.lit(":\n\t"), F.col("change"), F.lit(": ["),
                 F.array_join(F.sort_array(F.collect_list(F.col("a").cast("string"))), ", "),
                 F.lit("]")).alias("value"))
    pairs = paired.groupBy("entity", "change", "_chunk").agg(
        F.concat(F.col("entity"), F.lit(":\n\t"), F.col("change"), F.lit(":\n"),
                 F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("a", "b"))),
                                          lambda s: F.format_string("\t\t%d: %d", s["a"], s["b"])), "\n"))
        .alias("value"))
    return lists.select("value").unionByName(pairs.select("value"))
