"""Registered queries: ``(spark, sf_dir) -> DataFrame``.

Every query derives its inputs from the driver tables of ``sf_dir`` and
runs over all of them. Computed columns carry the same names as in the
matching oracle SQL (:mod:`twingraph.plans.oracles`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import confidence as conf
from ..operators import diff, graph

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _pair(spark, sf_dir):
    return fx.graph_pair(spark, sf_dir)


# --- Step 1: diff, structure, confidence ------------------------------------

@register
def q_node_diff(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return diff.node_diff(g.o_nodes, g.p_nodes)


@register
def q_edge_diff(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return diff.edge_diff(g.o_edges, g.p_edges)


@register
def q_diff_summary(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return diff.diff_summary(diff.node_diff(g.o_nodes, g.p_nodes), diff.edge_diff(g.o_edges, g.p_edges))


@register
def q_successors(spark, sf_dir):
    return graph.successors(_pair(spark, sf_dir).p_edges)


@register
def q_predecessors(spark, sf_dir):
    return graph.predecessors(_pair(spark, sf_dir).p_edges)


@register
def q_adjacent(spark, sf_dir):
    return graph.adjacent(_pair(spark, sf_dir).p_edges)


@register
def q_incident_edges(spark, sf_dir):
    return graph.incident_edges(_pair(spark, sf_dir).p_edges)


@register
def q_degrees(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return graph.degrees(g.p_nodes, g.p_edges)


@register
def q_edge_cost(spark, sf_dir):
    """Cost of every perturbed edge in the original graph (NULL / '-' = absent)."""
    g = _pair(spark, sf_dir)
    pairs = g.p_edges.select("src", "dst", F.col("weight").alias("own_cost"))
    res = graph.edge_cost(pairs, g.o_edges)
    return res.select("src", "dst", "own_cost", F.col("cost").alias("cost_in_original"),
                      graph.format_cost("cost").alias("cost_text"))


@register
def q_walk_start(spark, sf_dir):
    return graph.walk_start(_pair(spark, sf_dir).p_edges)


@register
def q_valuable_nodes(spark, sf_dir):
    return graph.valuable_nodes(_pair(spark, sf_dir).p_nodes)


@register
def q_discarded_nodes(spark, sf_dir):
    """Original nodes absent from P by value (removed or modified)."""
    g = _pair(spark, sf_dir)
    gone = graph.node_value_match(g.o_nodes, g.p_nodes, "left_anti")
    by_id = g.p_nodes.select("id").withColumn("_in_p", F.lit(True))
    return (gone.select("id").join(by_id, "id", "left")
            .select("id", F.when(F.col("_in_p"), F.lit("modified")).otherwise(F.lit("removed")).alias("reason")))


@register
def q_confidence(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return conf.confidence(g.o_nodes, g.o_edges, g.p_nodes, g.p_edges)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# --- Step 2: sources, pairing, scoring ---------------------------------------

from ..functions import scores as S  # noqa: E402
from ..operators import metrics as M  # noqa: E402
from ..operators import similarity as sim  # noqa: E402
from ..sources import codecs  # noqa: E402

_PAIR18 = [f"{s}_{c}" for s in ("o", "p") for c in
           ["id", "children", "props", "current_depth", "prop_value_range", "max_depth",
            "max_branching_factor", "max_properties", "stored_value"]]


@register
def q_node_pairs(spark, sf_dir):
    """K2/J1 (re-aimed): node pairs by id, 9 + 9 columns (no valuable flag)."""
    g = _pair(spark, sf_dir)
    return sim.pairs_by_id(g.o_nodes, g.p_nodes, "full_outer").select(*_PAIR18)


@register
def q_node_score(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return sim.node_scores(sim.pairs_by_id(g.o_nodes, g.p_nodes))


@register
def q_node_score_strict(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return sim.strict_scores(sim.pairs_by_id(g.o_nodes, g.p_nodes))


@register
def q_node_jaccard(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return sim.jaccard_scores(sim.pairs_by_id(g.o_nodes, g.p_nodes))


@register
def q_edge_pairs(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return sim.edge_pairs(g.o_edges, g.p_edges).drop("in_o", "in_p")


@register
def q_edge_score(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return sim.edge_scores(sim.edge_pairs(g.o_edges, g.p_edges))


@register
def q_edge_set_jaccard(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return sim.edge_set_jaccard(g.o_nodes, g.o_edges, g.p_nodes, g.p_edges)


@register
def q_best_match(spark, sf_dir):
    """Best original for every perturbed node among pairs scoring >= 0.5."""
    g = _pair(spark, sf_dir)
    return sim.best_match_exact(g.o_nodes, g.p_nodes)


@register
def q_confidence_pairs(spark, sf_dir):
    """C2 on (original, perturbed) pairs given by the best match."""
    from ..operators import confidence as conf
    g = _pair(spark, sf_dir)
    pairs = sim.best_match_exact(g.o_nodes, g.p_nodes).select(
        F.col("o_id").alias("original_id"), F.col("p_id").alias("perturbed_id"))
    return conf.confidence_pairs(pairs, g.o_nodes, g.o_edges, g.p_nodes, g.p_edges)


@register
def q_parse_nodes(spark, sf_dir):
    """Perturbed nodes rendered as node-record text and parsed back."""
    g = _pair(spark, sf_dir)
    text = codecs.nodes_to_text(g.p_nodes)
    return codecs.parse_nodes(text).select(*codecs.NODE_OUT, "arity")


@register
def q_nodes_json_roundtrip(spark, sf_dir):
    """Perturbed nodes through the JSON codec (flag written as a string)."""
    g = _pair(spark, sf_dir)
    return codecs.nodes_from_json(codecs.nodes_to_json(g.p_nodes))


@register
def q_extract_node_number(spark, sf_dir):
    """Perturbed id read from field 11 of each pair line; NULL when not a number."""
    g = _pair(spark, sf_dir)
    lines = codecs.pair_lines(sim.pairs_by_id(g.o_nodes, g.p_nodes, "full_outer"))
    return lines.select("line_id", codecs.extract_node_number("line").alias("node_number"))


# --- Step 3: metrics ----------------------------------------------------------

@register
def q_edge_traceability(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return M.edge_traceability(sim.edge_scores(sim.edge_pairs(g.o_edges, g.p_edges)))


def _node_score_rows(g):
    return sim.node_scores(sim.pairs_by_id(g.o_nodes, g.p_nodes))


@register
def q_node_traceability(spark, sf_dir):
    return M.node_traceability(_node_score_rows(_pair(spark, sf_dir)))


@register
def q_node_traceability_running(spark, sf_dir):
    return M.node_traceability_running(_node_score_rows(_pair(spark, sf_dir)))


@register
def q_node_verdict(spark, sf_dir):
    r = M.node_traceability_running(_node_score_rows(_pair(spark, sf_dir)))
    return r.select("o_id", "p_id", "precision", "verdict")


def _graph_counter_rows(g):
    strict = sim.strict_scores(sim.pairs_by_id(g.o_nodes, g.p_nodes, "left"))
    from ..operators.graph import node_value_match
    discarded = node_value_match(g.o_nodes, g.p_nodes, "left_anti").select(F.col("id").alias("d_id"))
    return M.graph_counter_rows(strict, discarded)


@register
def q_graph_counters(spark, sf_dir):
    return M.graph_counters(_graph_counter_rows(_pair(spark, sf_dir)))


@register
def q_precision_recall(spark, sf_dir):
    return M.precision_recall(M.graph_counters(_graph_counter_rows(_pair(spark, sf_dir))))


@register
def q_f1(spark, sf_dir):
    return M.f1_table(M.graph_counters(_graph_counter_rows(_pair(spark, sf_dir))))


@register
def q_pair_report(spark, sf_dir):
    return M.pair_report(_graph_counter_rows(_pair(spark, sf_dir)))


# --- Step 4/5: walks and paths -----------------------------------------------

from .. import constants as C  # noqa: E402
from ..operators import paths as P  # noqa: E402
from ..operators import walks as W  # noqa: E402


def _walks(spark, g):
    return W.random_walks(spark, g.p_edges, n_walks=C.N_WALKS, seed=C.SEED, max_steps=C.MAX_STEPS)


@register
def q_random_walks(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return _walks(spark, g)


@register
def q_walk_success(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return W.walk_summary(_walks(spark, g), g.p_nodes, g.p_edges, C.MAX_STEPS)


@register
def q_honeypot_hits(spark, sf_dir):
    g = _pair(spark, sf_dir)
    added = diff.node_diff(g.o_nodes, g.p_nodes).where(F.col("change") == "Added").select("id")
    return W.honeypot_hits(_walks(spark, g), added)


@register
def q_walk_stats(spark, sf_dir):
    g = _pair(spark, sf_dir)
    w = _walks(spark, g)
    return W.walk_stats(W.walk_summary(w, g.p_nodes, g.p_edges, C.MAX_STEPS), w, over="length")


@register
def q_walk_pairs_scored(spark, sf_dir):
    """J3 (re-aimed): every walked node against all originals, through the exact candidate join."""
    g = _pair(spark, sf_dir)
    walked = _walks(spark, g).select(F.col("node_id").alias("id")).distinct()
    return sim.best_match_counted(g.o_nodes, g.p_nodes.join(walked, "id", "left_semi"))


@register
def q_attack_tally(spark, sf_dir):
    g = _pair(spark, sf_dir)
    w = _walks(spark, g)
    walked = w.select(F.col("node_id").alias("id")).distinct()
    best = sim.best_match_exact(g.o_nodes, g.p_nodes.join(walked, "id", "left_semi"))
    return W.attack_tally(w, best, seed=C.SEED)


@register
def q_nearest_valuable(spark, sf_dir):
    g = _pair(spark, sf_dir)
    return P.nearest_valuable(g.p_nodes, g.p_edges).select("id", "hops", "target", "distance")


@register
def q_path_to_valuable(spark, sf_dir):
    g = _pair(spark, sf_dir)
    r = P.nearest_valuable(g.p_nodes, g.p_edges, paths=True)
    return r.select("id", "path", F.when(F.col("path") == "", F.lit(0))
                    .otherwise(F.size(F.split("path", ","))).cast("bigint").alias("path_nodes"))


@register
def q_nearest_valuable_weighted(spark, sf_dir):
    """D1 by edge weights."""
    g = _pair(spark, sf_dir)
    return P.nearest_valuable_weighted(g.p_nodes, g.p_edges)


@register
def q_sssp_hops(spark, sf_dir):
    g = _pair(spark, sf_dir)
    src = graph.walk_start(g.p_edges).select(F.col("start_id").alias("node"))
    return P.single_source_hops(src, g.p_edges)


# --- Step 6: move log ----------------------------------------------------------

from ..operators import replay as R  # noqa: E402


def _board(spark):
    return fx.board_nodes(spark), fx.board_edges(spark), fx.board_edges(spark, perturbed=True)


def _replayed(spark, sf_dir):
    nodes, edges, _ = _board(spark)
    return R.replay(fx.moves(spark, sf_dir), nodes, edges)


@register
def q_start_positions(spark, sf_dir):
    games = R.with_rounds(fx.moves(spark, sf_dir)).select("game_id", "round").distinct()
    return R.start_positions(games, fx.board_nodes(spark).select(F.col("id").alias("node")))


@register
def q_initial_verdict(spark, sf_dir):
    nodes, edges, _ = _board(spark)
    mv = R.with_rounds(fx.moves(spark, sf_dir))
    return R.placement(mv, R.node_facts(nodes, edges))


@register
def q_rounds(spark, sf_dir):
    return R.with_rounds(fx.moves(spark, sf_dir)).select("game_id", "seq", "round")


@register
def q_turn_audit(spark, sf_dir):
    return R.turn_audit(fx.moves(spark, sf_dir))


@register
def q_replay_moves(spark, sf_dir):
    return _replayed(spark, sf_dir)[0]


@register
def q_game_outcomes(spark, sf_dir):
    return _replayed(spark, sf_dir)[1]


def _replayed_illegal(spark, sf_dir):
    nodes, edges, _ = _board(spark)
    return R.replay(fx.moves(spark, sf_dir), nodes, edges, fx.board_rewired(spark), illegal_loses=True)


@register
def q_replay_illegal_loses(spark, sf_dir):
    """M4, rule f: a move that only the perturbed board allows loses the game."""
    return _replayed_illegal(spark, sf_dir)[0]


@register
def q_outcomes_illegal_loses(spark, sf_dir):
    return _replayed_illegal(spark, sf_dir)[1]


@register
def q_latest_positions(spark, sf_dir):
    return R.latest_positions(_replayed(spark, sf_dir)[1])


def _status(spark, sf_dir):
    from ..operators import status as ST
    nodes, edges, p_edges = _board(spark)
    mv = fx.moves(spark, sf_dir)
    return ST.player_status(R.latest_positions(R.replay(mv, nodes, edges)[1]), mv, nodes, edges, p_edges)


@register
def q_player_status(spark, sf_dir):
    return _status(spark, sf_dir).drop("path_ids", "adjacent_ids")


@register
def q_opponent_view(spark, sf_dir):
    from ..operators import status as ST
    return ST.opponent_view(_status(spark, sf_dir))


@register
def q_report_lines(spark, sf_dir):
    from ..operators import status as ST
    nodes, _, _ = _board(spark)
    return ST.report_lines(_status(spark, sf_dir), fx.moves(spark, sf_dir), nodes)


# --- Step 9: sources and sinks -----------------------------------------------

import uuid  # noqa: E402

from ..session import scratch_path  # noqa: E402
from ..sources import readers as RD  # noqa: E402
from ..sources import sinks as SK  # noqa: E402


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register
def q_dot_roundtrip(spark, sf_dir):
    """Perturbed graph written as DOT statements and read back with the DOT reader."""
    g = _pair(spark, sf_dir)
    path = _scratch(spark, "dot")
    RD.edges_to_dot(g.p_edges).unionByName(RD.nodes_to_dot(g.p_nodes)).write.mode("overwrite").text(path)
    edges, _ = RD.read_dot(spark, path)
    return edges.select("src", "dst", "weight")


@register
def q_report_roundtrip(spark, sf_dir):
    """S3 (+ writer): the perturbation diff as report text, read back as DELTA rows."""
    g = _pair(spark, sf_dir)
    delta = diff.as_delta(diff.node_diff(g.o_nodes, g.p_nodes), diff.edge_diff(g.o_edges, g.p_edges), g.p_edges)
    path = _scratch(spark, "report")
    SK.delta_report_docs(delta).write.mode("overwrite").text(path)
    return RD.read_delta(spark, path).select("entity", "change", "a", "b")


@register
def q_shards(spark, sf_dir):
    """K4: perturbed edges in shards of 35 rows in (src, dst) order."""
    return SK.shard(_pair(spark, sf_dir).p_edges, ["src", "dst"], C.SHARD_SIZE)


@register
def q_extract_formatted(spark, sf_dir):
    """K5 + P9: node / edge extract in groups of 10, costs from the original graph."""
    g = _pair(spark, sf_dir)
    return SK.extract_formatted(g.p_nodes, g.p_edges, g.o_edges, C.EXTRACT_GROUP)


@register
def q_moves_per_window(spark, sf_dir):
    """M12 batch twin: moves per player and hour."""
    from ..streaming.replay_stream import moves_per_window
    return moves_per_window(fx.moves(spark, sf_dir), C.WINDOW_MINUTES)


@register
def q_score_text(spark, sf_dir):
    """One text block per scored node pair."""
    return M.score_text(M.node_traceability_running(_node_score_rows(_pair(spark, sf_dir))))


# --- Further operators ----------------------------------------------------------

@register
def q_adjacency_dense(spark, sf_dir):
    """Cost rows over the start node of the walks and its successors."""
    g = _pair(spark, sf_dir)
    start = graph.walk_start(g.p_edges).select(F.col("start_id").alias("src"))
    ids = start.select(F.col("src").alias("id")).unionByName(
        g.p_edges.join(start, "src", "left_semi").select(F.col("dst").alias("id")))
    dense = graph.adjacency_dense(ids, g.p_edges)
    return dense.select("node", F.array_join(F.transform("costs", graph.format_cost), ",").alias("costs"))


@register
def q_has_edge(spark, sf_dir):
    """Original edges that are still there."""
    g = _pair(spark, sf_dir)
    return graph.has_edge(g.o_edges.select("src", "dst"), g.p_edges)


@register
def q_reconcile(spark, sf_dir):
    """T4: the diff against an operation log without modifications, in which removed edges were added first."""
    g = _pair(spark, sf_dir)
    delta = diff.as_delta(diff.node_diff(g.o_nodes, g.p_nodes), diff.edge_diff(g.o_edges, g.p_edges), g.p_edges)
    undone = delta.where("entity = 'Edges' AND change = 'Removed'").withColumn("change", F.lit("Added"))
    path = _scratch(spark, "log")
    log = delta.where("change <> 'Modified'").unionByName(undone)
    SK.write_text(SK.delta_report_docs(log), path)
    return diff.reconcile(delta, RD.read_delta(spark, path))


@register
def q_best_match_top3(spark, sf_dir):
    """X10 with k = 3 at its own threshold."""
    g = _pair(spark, sf_dir)
    return sim.best_match_top(g.o_nodes, g.p_nodes, k=3)


@register
def q_walk_node_stats(spark, sf_dir):
    """A8 over visited node ids."""
    w = _walks(spark, _pair(spark, sf_dir))
    return W.walk_stats(None, w, over="node_id")


@register
def q_pair_text(spark, sf_dir):
    """S6 + K6: node pairs written as combined lines and read back by name."""
    g = _pair(spark, sf_dir)
    path = _scratch(spark, "pairs")
    SK.write_combined_pairs(sim.pairs_by_id(g.o_nodes, g.p_nodes), path)
    return codecs.read_pairs(spark, path)


@register
def q_moves_json(spark, sf_dir):
    """Moves through Move documents and back."""
    return codecs.moves_from_json(codecs.moves_to_json(fx.moves(spark, sf_dir), fx.board_nodes(spark)))


@register
def q_status_of_users(spark, sf_dir):
    """M6 + P8: status of every user who sent a move, players or not."""
    from ..operators import status as ST
    users = fx.moves(spark, sf_dir).select("game_id", F.col("user").alias("role"))
    return ST.status_of(users, _status(spark, sf_dir))


@register
def q_graph_counters_triangular(spark, sf_dir):
    """A11 as a pass over the remaining originals after each one counts: the k-th original k times."""
    return M.graph_counters(_graph_counter_rows(_pair(spark, sf_dir)), triangular=True)


@register
def q_contained_nodes(spark, sf_dir):
    """G9 by id: original nodes whose id is still there."""
    g = _pair(spark, sf_dir)
    return graph.contained_nodes(g.o_nodes, g.p_nodes, by="id").select("id")


@register
def q_adjacency_tiles(spark, sf_dir):
    """G8 in tiles of 16 columns, over the start node of the walks and its successors."""
    g = _pair(spark, sf_dir)
    start = graph.walk_start(g.p_edges).select(F.col("start_id").alias("src"))
    ids = start.select(F.col("src").alias("id")).unionByName(
        g.p_edges.join(start, "src", "left_semi").select(F.col("dst").alias("id")))
    tiles = graph.adjacency_tiles(ids, g.p_edges, tile=16)
    return tiles.select("node", "row", "col_tile", F.array_join(F.transform("costs", graph.format_cost), ",").alias("costs"))


@register
def q_shards_roundtrip(spark, sf_dir):
    """K4: shards of 35 edges, packed into files and read back."""
    path = _scratch(spark, "shards")
    SK.write_shards(SK.shard(_pair(spark, sf_dir).p_edges, ["src", "dst"], C.SHARD_SIZE), path)
    return RD.read_shards(spark, path, "src bigint, dst bigint, weight double")


@register
def q_status_documents(spark, sf_dir):
    """Moves and status of every player as documents of 20 moves, read back."""
    from ..sources import codecs as CD
    nodes, _, _ = _board(spark)
    docs = CD.status_documents(_status(spark, sf_dir), fx.moves(spark, sf_dir), nodes, per_document=20)
    ids = lambda c: F.array_join(F.transform(c, lambda n: n["id"].cast("string")), ",")
    return CD.status_from_json(docs).select(
        "game_id", "role", "part", F.array_join(F.transform("moves", lambda m: F.concat(m["userId"], F.lit(":"), m["node"]["id"].cast("string"))), ",").alias("moves"),
        ids("adjacentNodes").alias("adjacent"), F.col("distanceToValuableNode").alias("distance"),
        ids("pathToValuableNode").alias("path"), F.col("confidenceScore").alias("confidence"))


@register
def q_graph_files(spark, sf_dir):
    """The perturbed graph written and loaded again, its edges with the stored values of their ends."""
    g, path = _pair(spark, sf_dir), _scratch(spark, "graph")
    RD.write_graph(g.p_nodes, g.p_edges, path)
    nodes, edges = RD.read_graph(spark, path)
    ends = [nodes.select(F.col("id").alias(e), F.col("stored_value").alias(f"{e}_value")) for e in ("src", "dst")]
    return edges.join(ends[0], "src", "left").join(ends[1], "dst", "left").select("src", "dst", "weight", "src_value", "dst_value")


@register
def q_node_csv(spark, sf_dir):
    """K1: node lines without a header, read back."""
    path = _scratch(spark, "nodes")
    SK.write_nodes_csv(_pair(spark, sf_dir).p_nodes, path)
    return codecs.read_nodes_csv(spark, path)


@register
def q_pair_text_header(spark, sf_dir):
    """Pair lines under a header line in every file, which the reader skips."""
    g, path = _pair(spark, sf_dir), _scratch(spark, "pairs")
    SK.write_combined_pairs(sim.pairs_by_id(g.o_nodes, g.p_nodes), path, header=True)
    return codecs.read_pairs(spark, path, header=True)


@register
def q_walk_text(spark, sf_dir):
    """K7: walk rows as text lines."""
    path = _scratch(spark, "walks")
    SK.write_text(_walks(spark, _pair(spark, sf_dir)).select(F.concat_ws(",", "walk_id", "step", "node_id").alias("value")), path)
    return spark.read.text(path)


@register
def q_score_lines(spark, sf_dir):
    """K8: edge scores as text lines."""
    g, path = _pair(spark, sf_dir), _scratch(spark, "scores")
    scored = sim.edge_scores(sim.edge_pairs(g.o_edges, g.p_edges))
    SK.write_text(scored.select(F.concat_ws(",", "src", "dst", F.col("score").cast("string")).alias("value")), path)
    return spark.read.text(path)


@register
def q_report_text(spark, sf_dir):
    """K9: the report lines of all players as text."""
    from ..operators import status as ST
    nodes, _, _ = _board(spark)
    path = _scratch(spark, "lines")
    SK.write_text(ST.report_lines(_status(spark, sf_dir), fx.moves(spark, sf_dir), nodes).select(F.col("line").alias("value")), path)
    return spark.read.text(path)


@register
def q_status_json(spark, sf_dir):
    """The nested status document of every player, read back."""
    path = _scratch(spark, "status")
    status = _status(spark, sf_dir).drop("path_ids", "adjacent_ids")
    SK.write_status_json(status, path)
    inner = ", ".join(f"{c}: {t}" for c, t in status.dtypes if c not in ("game_id", "role"))
    return spark.read.schema(f"game_id bigint, role string, status struct<{inner}>").json(path).select("game_id", "role", "status.*")


@register
def q_score_jitter(spark, sf_dir):
    """X11: node scores with their seeded offset."""
    g = _pair(spark, sf_dir)
    scored = sim.node_scores(sim.pairs_by_id(g.o_nodes, g.p_nodes))
    return scored.select("o_id", "p_id", F.round(S.jitter("score", "o_id", "p_id", C.SEED), 9).alias("score"))


@register
def q_stream_replay(spark, sf_dir):
    """The move log as a stream of four files, newest moves first, replayed from start to end of the stream."""
    from ..streaming import replay_stream as RS
    nodes, edges, _ = _board(spark)
    root = _scratch(spark, "stream")
    mv = fx.moves(spark, sf_dir).select("game_id", "seq", F.col("ts").cast("timestamp").alias("ts"), "user", "target")
    last = mv.agg(F.max("seq")).first()[0] or 1
    for part in (3, 2, 1, 0):
        quarter = F.least(F.lit(3), F.floor((F.col("seq") - 1) * 4 / F.lit(last)))
        mv.where(quarter == part).write.parquet(f"{root}/in/{3 - part}")
    stream = spark.readStream.schema(mv.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 16).parquet(f"{root}/in")
    query = (RS.stream_replay(stream, nodes, edges, watermark="3650 days").writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/state").outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("game_id", "seq", "round", "user", "target", "status", "thief_node", "police_node")
