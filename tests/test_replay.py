"""Move-log replay: profile, restart rounds, stream = batch, watermark."""

import os

import pytest
from pyspark.sql import functions as F

from twingraph import fixtures as fx
from twingraph.operators import replay as R
from twingraph.streaming import replay_stream as RS

from .conftest import SF_MID, SF_SMALL

PROFILE_SF001 = {"accepted": 397, "wrong_turn": 405, "invalid_move": 4734, "invalid_user": 1438,
                 "thief_wins": 7, "policeman_wins": 9, "thief_no_moves": 11, "policeman_no_moves": 3,
                 "game_over": 2996}


def _board(spark):
    return fx.board_nodes(spark), fx.board_edges(spark)


def test_status_profile(spark):
    nodes, edges = _board(spark)
    st, out = R.replay(fx.moves(spark, SF_MID, restarts=False), nodes, edges)
    got = {r["status"]: r["count"] for r in st.groupBy("status").count().collect()}
    assert got == PROFILE_SF001
    assert out.where("outcome = 'open'").count() == 90


def test_restart_opens_new_round(spark):
    nodes, edges = _board(spark)
    mv = fx.moves(spark, SF_SMALL, restarts=False)
    g0 = mv.agg(F.min("game_id")).first()[0]
    last = mv.where(F.col("game_id") == g0).agg(F.max("seq")).first()[0]
    extra = spark.createDataFrame([(g0, last + 1, None, "restart", 0, -1)], mv.schema)
    st, out = R.replay(mv.unionByName(extra).unionByName(
        mv.where(F.col("game_id") == g0).withColumn("seq", F.col("seq") + last + 1)), nodes, edges)
    rounds = out.where(F.col("game_id") == g0).orderBy("round").collect()
    assert [r["round"] for r in rounds] == [0, 1]
    assert rounds[1]["thief_start"] == (g0 * 7 + 3 + 1) % 25
    assert st.where((F.col("game_id") == g0) & (F.col("status") == "restart")).count() == 1


def _write_moves(spark, mv, root, order):
    """Write the moves as parquet files cut by time quantiles, in the given file order."""
    q = mv.approxQuantile("seq", [0.25, 0.5, 0.75], 0.0)
    cuts = [0] + q + [10 ** 9]
    parts = [mv.where((F.col("seq") > cuts[i]) & (F.col("seq") <= cuts[i + 1])) for i in range(4)]
    for i in order:
        parts[i].coalesce(1).write.mode("overwrite").parquet(os.path.join(root, f"part{i}"))
        os.utime(os.path.join(root, f"part{i}"))


def _run_stream(spark, src, schema, tmp_dir, nodes, edges, **options):
    """All files that are there and not yet read, one a batch, as rows written by the sink."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    out = os.path.join(tmp_dir, "out")
    q = (RS.stream_replay(stream, nodes, edges, **options).writeStream.format("parquet").option("path", out)
         .outputMode("append").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


MOVE_COLUMNS = ["game_id", "seq", "ts", "user", "target"]
STATUS_COLUMNS = ["game_id", "seq", "round", "user", "target", "status", "thief_node", "police_node"]


@pytest.mark.parametrize("order,illegal", [([0, 1, 2, 3], True), ([3, 1, 0, 2], False)])
def test_stream_equals_batch(spark, tmp_dir, order, illegal):
    """Files in any order, restarts in the log, the stream read in two runs from one checkpoint."""
    nodes, edges = _board(spark)
    p_edges = fx.board_rewired(spark)
    mv = fx.moves(spark, SF_SMALL).select(*MOVE_COLUMNS)
    src = os.path.join(tmp_dir, "in")
    options = dict(p_edges=p_edges, illegal_loses=illegal, watermark="3650 days")
    _write_moves(spark, mv, src, order[:2])
    _run_stream(spark, src, mv.schema, tmp_dir, nodes, edges, **options)
    _write_moves(spark, mv, src, order[2:])
    got = _run_stream(spark, src, mv.schema, tmp_dir, nodes, edges, **options)
    exp, _ = R.replay(mv, nodes, edges, p_edges, illegal_loses=illegal)
    assert got.count() == exp.count()
    assert got.select(*STATUS_COLUMNS).exceptAll(exp.select(*STATUS_COLUMNS)).count() == 0


def test_stream_gap_duplicate_and_late_rows(spark, tmp_dir):
    """A missing number holds its game until event time has passed by the wait; what comes after is reported."""
    nodes, edges, adjacent = _ring(spark, 24)
    schema = "game_id long, seq long, ts timestamp, user string, target long"
    src = os.path.join(tmp_dir, "in")
    walk = [("thief", 9), ("policeman", 17), ("thief", 10), ("policeman", 18), ("thief", 11), ("policeman", 19)]

    def send(name, rows):
        rows = [(g, s, f"2024-01-01 {h:02d}:00:00", u, t) for g, s, h, u, t in rows]
        df = spark.createDataFrame(rows, "game_id long, seq long, ts string, user string, target long")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(os.path.join(src, name))

    def run():
        out = _run_stream(spark, src, spark.createDataFrame([], schema).schema, tmp_dir, nodes, edges, wait_minutes=120, watermark="0 seconds")
        return sorted((r["game_id"], r["seq"], r["status"], r["n_missing"]) for r in out.collect())

    game = lambda g, seqs, hour: [(g, s, hour, *walk[s - 1]) for s in seqs]
    send("a", game(1, [1, 2, 4], 1) + game(25, [1, 1, 2, 3], 1))
    first = run()
    assert first == [(1, 1, "accepted", None), (1, 2, "accepted", None), (25, 1, "accepted", None), (25, 1, "duplicate", None),
                     (25, 2, "accepted", None), (25, 3, "accepted", None)]
    send("b", game(25, [4], 2) + game(1, [6], 2) + game(1, [2], 2))  # in time; 3 and 5 of game 1 are missing
    assert run() == sorted(first + [(25, 4, "accepted", None), (1, 2, "duplicate", None)])
    send("c", game(25, [5], 9))   # event time passes the wait
    send("d", game(25, [6], 10))
    third = run()
    held = [x for x in third if x[0] == 1]
    # the policeman's move 4 was held back by the thief's missing move 3, so it is not the policeman's turn
    assert held == [(1, 1, "accepted", None), (1, 2, "accepted", None), (1, 2, "duplicate", None), (1, 3, "missing", 1),
                    (1, 4, "wrong_turn", None), (1, 5, "missing", 1), (1, 6, "invalid_move", None)]
    assert [x for x in third if x[0] == 25][-1] == (25, 6, "accepted", None)
    send("e", game(1, [3], 11) + game(1, [4], 11))
    last = run()
    assert sorted(set(last) - set(third)) == [(1, 3, "late", None), (1, 4, "duplicate", None)]


def test_windowed_counts_drop_late_rows(spark, tmp_dir):
    mv = fx.moves(spark, SF_SMALL).select("game_id", "seq", "ts", "user", "target")
    src = os.path.join(tmp_dir, "win")
    mv.coalesce(1).write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(mv.schema).option("recursiveFileLookup", "true").parquet(src)
    agg = RS.moves_per_window(stream, 60, watermark="1 hour")
    out, ck = os.path.join(tmp_dir, "win_out"), os.path.join(tmp_dir, "ckw")

    def run():
        q = (agg.writeStream.format("parquet").option("path", out).outputMode("append")
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    late = mv.limit(5).withColumn("ts", F.col("ts") - F.expr("INTERVAL 10 DAYS"))
    late.coalesce(1).write.parquet(os.path.join(src, "b"))
    run()  # restarts from the checkpoint; the late rows are behind the watermark
    closed = spark.read.parquet(out)
    batch = RS.moves_per_window(mv, 60)
    # every emitted window equals the batch count; the late rows never appear
    assert closed.exceptAll(batch).count() == 0
    assert closed.count() >= 0.9 * batch.count()


def test_start_positions_are_nodes_of_the_board(spark):
    nodes = spark.createDataFrame([(n,) for n in (100, 7, 52)], "node long")
    games = spark.createDataFrame([(1, 0), (2, 0), (2, 1)], "game_id long, round long")
    got = {(r["game_id"], r["round"]): (r["thief_start"], r["police_start"]) for r in R.start_positions(games, nodes).collect()}
    order = [7, 52, 100]
    assert got == {(g, r): (order[(g * 7 + r * 3 + 1) % 3], order[(g * 11 + r * 5 + 5) % 3]) for g, r in [(1, 0), (2, 0), (2, 1)]}
    assert R.start_positions(games, nodes.where("node < 0")).where("thief_start is null and police_start is null").count() == 3


def test_no_moves_comes_before_caught(spark):
    facts = spark.createDataFrame([(3, True, False)], "node long, sink boolean, valuable boolean")
    mv = spark.createDataFrame([(1, 0)], "game_id long, round long")
    assert R.placement(mv, facts).first()["placement_verdict"] == "thief_no_moves"


@pytest.mark.parametrize("illegal", [False, True])
def test_composed_blocks_equal_whole_rounds(spark, illegal):
    """Blocks of 5 moves, joined through their maps, give exactly what one fold per round gives."""
    nodes, edges = _board(spark)
    mv = fx.moves(spark, SF_SMALL)
    p_edges = fx.board_rewired(spark)
    st1, out1 = R.replay(mv, nodes, edges, p_edges, illegal_loses=illegal)
    st5, out5 = R.replay(mv, nodes, edges, p_edges, illegal_loses=illegal, block=5)
    assert st1.count() == st5.count() == mv.count()
    assert st1.exceptAll(st5).count() == 0
    assert out1.exceptAll(out5).count() == 0
    assert (st1.where("status like '%illegal'").count() > 0) == illegal


def _plain_replay(moves, adjacent, p_adjacent, sinks, valuable, t, p, illegal):
    """One round, move by move; ``moves`` are (user, target)."""
    turn, verdict, out = "thief", None, []
    for user, target in moves:
        mine = t if user == "thief" else p
        if verdict:
            status = "game_over"
        elif user not in ("thief", "policeman"):
            status = "invalid_user"
        elif user == "policeman" and p == t:
            status = verdict = "policeman_wins"
        elif target not in adjacent[mine]:
            status = "invalid_move"
            if illegal and user == turn and target in p_adjacent[mine]:
                status = verdict = user + "_illegal"
        elif user != turn:
            status = "wrong_turn"
        else:
            t, p = (target, p) if user == "thief" else (t, target)
            end = ("thief_wins" if target in valuable else None) if user == "thief" else ("policeman_wins" if target == t else None)
            verdict = end or (user + "_no_moves" if target in sinks else None)
            turn = "policeman" if user == "thief" else "thief"
            status = verdict or "accepted"
        out.append((status, t, p))
    return out


def _ring(spark, n):
    nodes = spark.range(n).select("id", F.lit(False).alias("valuable_data"))
    edges = spark.range(n).select(F.explode(F.array(F.struct(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst")),
                                                    F.struct(F.col("id").alias("src"), ((F.col("id") + 7) % n).alias("dst")))).alias("e"))
    adjacent = {i: {(i + d) % n for d in (1, 7, -1, -7)} for i in range(n)}
    return nodes, edges.select("e.src", "e.dst", F.lit(1.0).alias("weight")), adjacent


def test_one_game_of_a_million_moves(spark):
    """A single round that stays open: the players keep to the two halves of a ring."""
    n, size = 24, 1_000_000
    nodes, edges, adjacent = _ring(spark, n)
    i = F.col("id")
    mixed = F.pmod(F.xxhash64(i), F.lit(1 << 30))
    mv = spark.range(0, size, 1, 8).select(
        F.lit(1).cast("long").alias("game_id"), (i + 1).alias("seq"),
        F.when(mixed % 2 == 0, "thief").otherwise("policeman").alias("user"),
        ((mixed / 2).cast("long") % 12 + F.when(mixed % 2 == 0, 0).otherwise(12)).alias("target"))
    st, out = R.replay(mv, nodes, edges)
    rows = st.orderBy("seq").select("user", "target", "status", "thief_node", "police_node").toPandas()
    assert len(rows) == size
    plain = _plain_replay(zip(rows["user"], rows["target"]), adjacent, adjacent, set(), set(), 8, 16, False)
    assert list(zip(rows["status"], rows["thief_node"], rows["police_node"])) == plain
    assert (rows["status"] == "accepted").sum() > 100_000
    end = out.collect()
    assert len(end) == 1 and end[0]["outcome"] == "open" and end[0]["n_moves"] == size
    assert (end[0]["thief_node"], end[0]["police_node"]) == plain[-1][1:]


@pytest.mark.parametrize("illegal", [False, True])
def test_hub_board_with_odd_rows(spark, illegal):
    """A hub, a self loop, a move off the board, null users and targets, in blocks of 3."""
    nodes = spark.createDataFrame([(i, False) for i in range(40)], "id long, valuable_data boolean")
    links = [(0, i) for i in range(1, 40)] + [(i, 0) for i in range(1, 40)] + [(5, 5), (3, 99)]
    p_links = links + [(i, i + 1) for i in range(1, 39)]
    edges, p_edges = (spark.createDataFrame([(a, b, 1.0) for a, b in x], "src long, dst long, weight double") for x in (links, p_links))
    moves = [("thief", 0), ("policeman", 0), ("Thief", 5), ("POLICEMAN", 7), ("thief", 5), (None, 3), ("thief", 99), ("policeman", None),
             ("policeman", 0), ("thief", 6), ("thief", 0), ("policeman", 9), ("policeman", 4)]
    mv = spark.createDataFrame([(2, k + 1, u, t) for k, (u, t) in enumerate(moves)], "game_id long, seq long, user string, target long")
    st, _ = R.replay(mv, nodes, edges, p_edges, illegal_loses=illegal, block=3)
    both = [{i: set() for i in range(100)} for _ in range(2)]
    for adj, given in zip(both, (links, p_links)):
        for a, b in given:
            if b < 40:
                adj[a].add(b)
                adj[b].add(a)
    want = _plain_replay([((u or "").lower(), t) for u, t in moves], *both, set(), set(), (2 * 7 + 1) % 40, (2 * 11 + 5) % 40, illegal)
    got = [(r["status"], r["thief_node"], r["police_node"]) for r in st.orderBy("seq").collect()]
    assert got == want


def test_empty_log(spark):
    nodes, edges = _board(spark)
    st, out = R.replay(fx.moves(spark, SF_SMALL).where("game_id < 0"), nodes, edges)
    assert st.count() == 0 and out.count() == 0
    with pytest.raises(ValueError):
        R.replay(fx.moves(spark, SF_SMALL), nodes, edges, illegal_loses=True)
