"""Player status on a board pair.

For every player of every game at once: current node, adjacent nodes in the
original board, hops / path / distance to the nearest valuable node in the
perturbed board, confidence of the node, and the moves the player sent.
:func:`status_of` answers for any user; unknown ones get the defaults of P8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .confidence import confidence
from .graph import undirected
from .kernel import cut_lineage
from .paths import nearest_valuable


def player_status(positions: DataFrame, moves: DataFrame, nodes: DataFrame, edges: DataFrame,
                  p_edges: DataFrame) -> DataFrame:
    """M6 flattened: ``(game_id, role, node, adjacent, hops, distance, path, confidence, n_moves)``."""
    positions = cut_lineage(positions)  # read twice; comes from the fold of all moves
    adj = (undirected(edges).groupBy("node")
           .agg(F.sort_array(F.collect_list("nbr")).alias("adjacent_ids")))
    near = nearest_valuable(nodes, p_edges, paths=True).select(
        F.col("id").alias("node"), "hops", F.col("path").alias("path"))
    conf = confidence(nodes, edges, nodes, p_edges).select(F.col("id").alias("node"), F.col("score").alias("confidence"))
    n_moves = (moves.groupBy("game_id", F.lower("user").alias("role"))
               .agg(F.count(F.lit(1)).cast("bigint").alias("n_moves")))
    thief_sv = (positions.where(F.col("role") == C.THIEF)
                .join(nodes.select(F.col("id").alias("node"), "stored_value"), "node")
                .select("game_id", F.col("stored_value").alias("thief_sv")))
    s = (positions.join(adj, "node", "left").join(near, "node", "left").join(conf, "node", "left")
         .join(n_moves, ["game_id", "role"], "left").join(thief_sv, "game_id", "left"))
    hops = F.coalesce("hops", F.lit(C.UNREACHABLE).cast("bigint"))
    return s.select(
        "game_id", "role", "node",
        F.array_join(F.coalesce("adjacent_ids", F.array().cast("array<bigint>")).cast("array<string>"), ",")
        .alias("adjacent"),
        hops.alias("hops"),
        F.when(hops != C.UNREACHABLE, hops.cast("double") * F.col("thief_sv")).alias("distance"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("n_moves", F.lit(0)).cast("bigint").alias("n_moves"),
        "adjacent_ids", F.split(F.coalesce("path", F.lit("")), ",").alias("path_ids"))


def status_of(players: DataFrame, status: DataFrame) -> DataFrame:
    """Status of the asked ``(game_id, role)``; a user without one has no moves, is unreachable and scores 0.0."""
    known = status.drop("path_ids", "adjacent_ids")
    asked = players.select("game_id", F.lower("role").alias("role")).distinct()
    return asked.join(known, ["game_id", "role"], "left").select(
        "game_id", "role", "node", F.coalesce("adjacent", F.lit("")).alias("adjacent"),
        F.coalesce("hops", F.lit(C.UNREACHABLE).cast("bigint")).alias("hops"), "distance",
        F.coalesce("path", F.lit("")).alias("path"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("n_moves", F.lit(0)).cast("bigint").alias("n_moves"))


def opponent_view(status: DataFrame) -> DataFrame:
    """M7: each player sees the opponent's node and its adjacent nodes."""
    opp = status.select("game_id", F.col("role").alias("opp_role"), F.col("node").alias("opponent_node"),
                        F.col("adjacent").alias("opponent_adjacent"))
    return (status.select("game_id", "role").join(opp, "game_id")
            .where(F.col("role") != F.col("opp_role")).drop("opp_role"))


def report_lines(status: DataFrame, moves: DataFrame, nodes: DataFrame) -> DataFrame:
    """The five report sections per player as ``(game_id, role, section, ord, line)``.

    A move whose target is no node names the target alone.
    """
    status = cut_lineage(status)  # read by every section
    ntext = nodes.select("id", F.concat(F.lit("NodeObject("), F.concat_ws(",", *[
        F.col(c).cast("string") for c in nodes.columns]), F.lit(")")).alias("txt"))
    path = (status.select("game_id", "role", F.posexplode("path_ids").alias("ord", "pid"))
            .where(F.col("pid") != "")
            .join(ntext, F.col("pid").cast("bigint") == ntext["id"])
            .select("game_id", "role", F.lit(1).alias("section"), F.col("ord").cast("bigint").alias("ord"),
                    F.concat(F.lit("Path to Valuable Node: "), "txt").alias("line")))
    score = status.select("game_id", "role", F.lit(2).alias("section"), F.lit(0).cast("bigint").alias("ord"),
                          F.concat(F.lit("Confidence Score: "), F.col("confidence").cast("string")).alias("line"))
    adj = (status.select("game_id", "role", F.explode("adjacent_ids").alias("aid"))
           .join(ntext, F.col("aid") == ntext["id"])
           .select("game_id", "role", F.lit(3).alias("section"), F.col("aid").alias("ord"),
                   F.concat(F.lit("Adjacent Node: "), "txt").alias("line")))
    mv = (moves.select("game_id", F.lower("user").alias("role"), "seq", "user", "target")
          .join(status.select("game_id", "role"), ["game_id", "role"])
          .join(ntext, F.col("target") == ntext["id"], "left")
          .withColumn("txt", F.coalesce("txt", F.concat(F.lit("NodeObject("), F.coalesce(F.col("target").cast("string"), F.lit("")), F.lit(")"))))
          .select("game_id", "role", F.lit(4).alias("section"), F.col("seq").cast("bigint").alias("ord"),
                  F.concat(F.lit("Move: Move("), F.coalesce("user", F.lit("")), F.lit(","), F.col("txt"), F.lit(")")).alias("line")))
    dist = status.select("game_id", "role", F.lit(5).alias("section"), F.lit(0).cast("bigint").alias("ord"),
                         F.concat(F.lit("Distance to Valuable Node: "),
                                  F.coalesce(F.col("distance").cast("string"), F.lit(C.INFINITY_TEXT))).alias("line"))
    return path.unionByName(score).unionByName(adj).unionByName(mv).unionByName(dist).select(
        "game_id", "role", F.col("section").cast("bigint").alias("section"), "ord", "line")
