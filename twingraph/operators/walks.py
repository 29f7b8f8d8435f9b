"""Seeded random walks on a directed graph.

A walk moves from its node to the out-neighbour at position
``mix(walk, step) % out_degree`` of the ascending neighbour list and stops
at a sink or after ``max_steps`` nodes. The neighbour lists are long rows
``(node, pos, nbr, nbr_deg)``, written once as a table bucketed by
``(node, pos)``: a hub's neighbours lie in many buckets, and a join on these
columns reads the table where it lies. Every step therefore exchanges the
frontier alone, one narrow row per walk that still moves. ``STEPS_A_JOB``
steps are one job, whose result is appended to a log of ``(walk, node)``
columns; the next job starts from the last column of that part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.hashing import draw, mix
from ..session import scratch_path
from .graph import successors, usable_edges, walk_start
from .kernel import Bucketed, cut_lineage, select_ranks

STEPS_A_JOB = 7  # joins of one plan; the log is a lineage cut after each


def neighbour_table(edges: DataFrame) -> DataFrame:
    """``(node, pos, nbr, nbr_deg)`` with ``nbr_deg`` the out-degree of ``nbr`` (0 = sink)."""
    edges = usable_edges(edges)  # idempotent; callers may pass raw edges
    succ = successors(edges)
    deg = edges.groupBy(F.col("src").alias("nbr")).agg(F.count(F.lit(1)).alias("nbr_deg"))
    return (succ.join(deg, "nbr", "left")
            .select("node", "pos", "nbr", F.coalesce("nbr_deg", F.lit(0)).cast("bigint").alias("nbr_deg")))


def take_step(frontier: DataFrame, nbrs: DataFrame, step: int, seed: int, out: str) -> DataFrame:
    """Add ``out``, the node of every walk after ``step`` (null for a walk that has ended), and renew ``deg``.

    ``frontier`` has ``walk_id``, ``at`` (present node), ``deg``. An ended walk asks for a place of its own
    that no neighbour has, so ended walks do not gather under one key.
    """
    place = F.when(F.col("deg") > 0, mix("walk_id", F.lit(step), seed) % F.col("deg")).otherwise(-1 - F.col("walk_id"))
    asked = frontier.withColumn("_at", F.coalesce("at", "walk_id")).withColumn("_pos", place.cast("bigint"))
    # the few walks are hashed and the neighbours stream past them, unsorted
    met = asked.hint("shuffle_hash").join(nbrs, (F.col("_at") == nbrs["node"]) & (F.col("_pos") == nbrs["pos"]), "left")
    kept = [c for c in frontier.columns if c not in ("at", "deg")]
    return met.select(*kept, F.col("nbr").alias(out), F.col("nbr").alias("at"),
                      F.coalesce("nbr_deg", F.lit(0)).cast("bigint").alias("deg"))


def random_walks(spark: SparkSession, edges: DataFrame, n_walks: int = C.N_WALKS, seed: int = C.SEED,
                 max_steps: int = C.MAX_STEPS, start: DataFrame | None = None) -> DataFrame:
    """Rows ``(walk_id, step, node_id)``, step 0 being the start node.

    ``start`` is a one-row frame with column ``start_id`` (default: G10). The plan is the same for any number
    of walks: each step exchanges and hashes the frontier and reads the bucketed neighbours.
    """
    if max_steps < 1:
        raise ValueError("max_steps must be >= 1")
    # The edge table feeds several jobs below (ranking, degrees, start node): derive it once.
    edges = cut_lineage(usable_edges(edges))
    start = start if start is not None else walk_start(edges)
    out_deg = edges.groupBy(F.col("src").alias("start_id")).agg(F.count(F.lit(1)).alias("deg"))
    s = (start.select("start_id").join(out_deg, "start_id", "left")
         .select("start_id", F.coalesce("deg", F.lit(0)).cast("bigint").alias("deg")).withColumn("_k", F.lit(0)))
    # s has exactly one row: an equi-join on a constant key broadcasts it.
    walks = spark.range(0, n_walks).select(F.col("id").alias("walk_id"), F.lit(0).alias("_k")).join(F.broadcast(s), "_k")
    log = scratch_path(spark, f"walks-{uuid.uuid4().hex}")
    parts = []

    def append(wide: DataFrame, first: int, steps: int) -> DataFrame:
        """Add a part of the log: columns ``n0, n1, ...`` are the nodes of steps ``first, first + 1, ...``."""
        path = f"{log}/{first}"
        wide.write.parquet(path)
        part = spark.read.schema(wide.schema).parquet(path)
        nodes = F.array(*[F.col(f"n{i}") for i in range(steps)])
        parts.append(part.select("walk_id", F.posexplode(nodes).alias("i", "node_id")).where("node_id is not null")
                     .select("walk_id", (F.col("i") + first).cast("bigint").alias("step"), "node_id"))
        return part

    part = append(walks.select("walk_id", F.col("start_id").alias("n0"), "deg"), 0, 1)
    last = "n0"
    with Bucketed(neighbour_table(edges), ["node", "pos"]) as nbrs:
        for first in range(1, max_steps, STEPS_A_JOB):
            moving = part.where("deg > 0").select("walk_id", F.col(last).alias("at"), "deg")
            if moving.isEmpty():
                break
            steps = min(STEPS_A_JOB, max_steps - first)
            for i in range(steps):
                moving = take_step(moving, nbrs.table(), first + i, seed, f"n{i}")
            last = f"n{steps - 1}"
            part = append(moving.select("walk_id", *[f"n{i}" for i in range(steps)], "deg"), first, steps)
    result = parts[0]
    for more in parts[1:]:
        result = result.unionByName(more)
    return result


def walk_summary(walks: DataFrame, nodes: DataFrame, edges: DataFrame, max_steps: int = C.MAX_STEPS) -> DataFrame:
    """Per walk its length, last node, success (last node valuable), truncation (it could still have moved)."""
    last = walks.groupBy("walk_id").agg(
        F.count(F.lit(1)).alias("length"), F.max_by("node_id", "step").alias("last_node"))
    val = nodes.select(F.col("id").alias("last_node"), "valuable_data")
    outd = usable_edges(edges).groupBy(F.col("src").alias("last_node")).agg(F.count(F.lit(1)).alias("_od"))
    res = last.join(val, "last_node", "left").join(outd, "last_node", "left")
    return res.select(
        "walk_id", F.col("length").cast("bigint").alias("length"), "last_node",
        F.coalesce("valuable_data", F.lit(False)).alias("success"),
        ((F.col("length") >= max_steps) & (F.coalesce("_od", F.lit(0)) > 0)).alias("truncated"))


def honeypot_hits(walks: DataFrame, added_ids: DataFrame) -> DataFrame:
    """Per walk, steps on nodes added by the perturbation and distinct ones."""
    added = added_ids.select(F.col("id").alias("node_id")).withColumn("_added", F.lit(1))
    j = walks.join(added, "node_id", "left")
    return j.groupBy("walk_id").agg(
        F.sum(F.coalesce("_added", F.lit(0))).cast("bigint").alias("honeypot_steps"),
        F.count_distinct(F.when(F.col("_added") == 1, F.col("node_id"))).cast("bigint").alias("honeypots"))


def walk_stats(summary: DataFrame, walks: DataFrame, over: str = "length") -> DataFrame:
    """Min / max / median / mean of walk lengths (or of visited node ids); the median is selected, not buffered."""
    if over == "length":
        v = summary.select(F.col("length").alias("v"))
    elif over == "node_id":
        v = walks.where(F.col("step") > 0).select(F.col("node_id").alias("v"))
    else:
        raise ValueError(over)
    v = cut_lineage(v.select(F.col("v").cast("bigint").alias("v")))
    n = v.count()
    middle = select_ranks(v, "v", sorted({max(n - 1, 0) // 2, n // 2}))
    known = [m for m in middle if m is not None]
    median = F.lit((known[0] + known[-1]) / 2 if known else None).cast("double")
    return v.agg(F.min("v").alias("min_v"), F.max("v").alias("max_v"), F.first(median).alias("median_v"),
                 F.avg(F.col("v").cast("double")).alias("mean_v"), F.count(F.lit(1)).alias("n"))


def attack_tally(walks: DataFrame, node_scores: DataFrame, seed: int = C.SEED) -> DataFrame:
    """A9 per walk: every visited node after the start is an attack attempt.

    A seeded draw <= 0.75 counts as a success (twice when the node's best
    match score is >= 0.55), otherwise as a failure.
    """
    steps = walks.where(F.col("step") > 0)
    sc = node_scores.select(F.col("p_id").alias("node_id"), F.col("score").alias("_s"))
    j = steps.join(sc, "node_id", "left")
    hit = draw("walk_id", "step", seed + 1) <= F.lit(C.ATTACK_DRAW)
    strong = F.coalesce(F.col("_s"), F.lit(0.0)) >= F.lit(C.ATTACK_SCORE)
    return j.groupBy("walk_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("attempts"),
        F.sum(F.when(hit, F.when(strong, 2).otherwise(1)).otherwise(0)).cast("bigint").alias("successful"),
        F.count_if(~hit).cast("bigint").alias("failed"))
