"""Move-log adjudication on a board graph.

Replay contract (batch, stream and oracle agree):

* state per (game, round): thief node, policeman node, whose turn, verdict;
* placement verdict, first match wins: thief on a valuable node ->
  ``thief_wins``; thief on a sink -> ``thief_no_moves``; policeman on a sink ->
  ``policeman_no_moves``; both on one node -> ``policeman_wins``;
* then per move in ``seq`` order: verdict set -> ``game_over``; unknown user
  -> ``invalid_user``; policeman row while on the thief -> ``policeman_wins``;
  target not adjacent (either direction) to the mover's node ->
  ``invalid_move``; not the mover's turn -> ``wrong_turn``; else the move
  is applied and the status is the new verdict (thief: valuable, then sink;
  policeman: catch, then sink) or ``accepted`` with the turn passed on;
* with ``illegal_loses`` a move of the player whose turn it is, to a node that is
  adjacent in the perturbed board only, is not ``invalid_move`` but loses the game:
  ``thief_illegal`` or ``policeman_illegal``, positions as they were;
* a ``restart`` row opens the next round with fresh start positions.

The moves of a game are cut into blocks. A round that lies in one block is folded from
its placement. In a longer round every block is first made a map from the states that
may stand at its start to the state at its end (states that meet go on as one); maps
of neighbouring blocks are composed level by level, the start state of each block is
read off on the way back, and then all blocks are folded at once. Moves carry no
neighbour lists: what a block needs of the board is the edges between its targets and
the nodes on which a player of its round can stand, found by a join with the edges,
each of which is kept at its endpoint of lower degree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import share_package
from .graph import undirected
from .kernel import HOT, cut_lineage, prefix_rank, prefix_sum

VERDICTS = ["thief_wins", "policeman_wins", "thief_no_moves", "policeman_no_moves", "thief_illegal", "policeman_illegal"]
RESTART = "restart"
BLOCK = 1024   # moves of a game in a block
FAN = 64       # neighbouring maps that one task composes
ADJACENT, PERTURBED_ONLY = 1, 2  # how a target and a stand are linked


def start_positions(games: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(game_id, round, thief_start, police_start)``, nodes of the board picked by a seeded formula.

    The formula gives a place in the ascending list of the column ``node``, whatever
    the ids are; an empty board gives null positions.
    """
    places = prefix_rank(nodes.select("node").distinct(), [], ["node"], out="_place")
    size = places.count()
    g, r = F.col("game_id"), F.col("round")
    n = F.lit(size or None).cast("bigint")
    drawn = games.select("game_id", "round", F.pmod(g * 7 + r * 3 + 1, n).alias("_t"), F.pmod(g * 11 + r * 5 + 5, n).alias("_p"))
    t = places.select(F.col("_place").alias("_t"), F.col("node").alias("thief_start"))
    p = places.select(F.col("_place").alias("_p"), F.col("node").alias("police_start"))
    return (drawn.join(t, "_t", "left").join(p, "_p", "left")
            .select("game_id", "round", "thief_start", "police_start"))


def node_facts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """M2 lookup table of targets: ``(node, sink, valuable)``."""
    outd = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("_od"))
    n = nodes.select(F.col("id").alias("node"), F.col("valuable_data").alias("valuable"))
    return n.join(outd, "node", "left").select("node", (F.coalesce("_od", F.lit(0)) == 0).alias("sink"), "valuable")


def _numbered(moves: DataFrame) -> DataFrame:
    """Moves with ``round`` and ``_no``, their 1-based number in the game (one skew-safe pass)."""
    flagged = moves.withColumn("_rs", F.when(F.lower("user") == RESTART, 1).otherwise(0))
    run = prefix_sum(flagged, ["game_id"], ["seq"], {"_cum": "_rs", "_no": F.lit(1)}, hot=HOT)
    return run.withColumn("round", (F.col("_cum") - F.col("_rs")).cast("bigint")).drop("_cum", "_rs")


def with_rounds(moves: DataFrame) -> DataFrame:
    """M9: round = number of restart rows before each row of its game (skew-safe running sum)."""
    return _numbered(moves).drop("_no")


def placement(moves: DataFrame, facts: DataFrame) -> DataFrame:
    """Per (game, round) start positions and the placement verdict."""
    games = moves.select("game_id", "round").distinct()
    sp = start_positions(games, facts)
    tf = facts.select(F.col("node").alias("thief_start"), F.col("sink").alias("t_sink"),
                      F.col("valuable").alias("t_val"))
    pf = facts.select(F.col("node").alias("police_start"), F.col("sink").alias("p_sink"))
    j = sp.join(tf, "thief_start", "left").join(pf, "police_start", "left")
    verdict = (F.when(F.col("t_val"), F.lit("thief_wins"))
               .when(F.col("t_sink"), F.lit("thief_no_moves"))
               .when(F.col("p_sink"), F.lit("policeman_no_moves"))
               .when(F.col("thief_start") == F.col("police_start"), F.lit("policeman_wins")))
    return j.select("game_id", "round", "thief_start", "police_start", verdict.alias("placement_verdict"))


def adjudicate(state: list, user: str | None, target, sink: bool, valuable: bool, link: int) -> str:
    """One move under the contract: changes ``state`` (thief, policeman, turn, verdict) and returns the status.

    ``link`` says how ``target`` is linked with the mover's node (0: not at all).
    """
    t, p, turn, verdict = state
    if verdict is not None:
        return "game_over"
    if user != C.THIEF and user != C.POLICEMAN:
        return "invalid_user"
    if user == C.POLICEMAN and p is not None and p == t:
        state[3] = "policeman_wins"
        return "policeman_wins"
    if link != ADJACENT:
        if link == PERTURBED_ONLY and user == turn:
            state[3] = f"{user}_illegal"
            return state[3]
        return "invalid_move"
    if user != turn:
        return "wrong_turn"
    if user == C.THIEF:
        state[0] = target
        status = "thief_wins" if valuable else "thief_no_moves" if sink else "accepted"
    else:
        state[1] = target
        status = "policeman_wins" if target == t else "policeman_no_moves" if sink else "accepted"
    if status == "accepted":
        state[2] = C.POLICEMAN if user == C.THIEF else C.THIEF
    else:
        state[3] = status
    return status


# --- what a block needs of the board ---------------------------------------------

def _low_degree_lists(und: DataFrame) -> DataFrame:
    """``(node, other)``: every undirected edge once, at its endpoint of lower degree, so a hub keeps few."""
    deg = und.groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    both = (und.join(deg, "node").join(deg.select(F.col("node").alias("nbr"), F.col("d").alias("d2")), "nbr"))
    return both.where("d < d2 or (d = d2 and node <= nbr)").select("node", F.col("nbr").alias("other"))


def _links(targets: DataFrame, stands: DataFrame, edges: DataFrame) -> DataFrame:
    """``(game_id, round, block, target, stand)``: pairs of a block's targets and its round's stands that an edge links."""
    lists = cut_lineage(_low_degree_lists(undirected(edges)))
    key = ["game_id", "round"]
    from_target = (targets.join(lists.select(F.col("node").alias("target"), F.col("other").alias("stand")), "target")
                   .join(stands, [*key, "stand"], "left_semi"))
    from_stand = (stands.join(lists.where("node <> other").select(F.col("node").alias("stand"), F.col("other").alias("target")), "stand")
                  .join(targets, [*key, "target"]))
    columns = [*key, "block", "target", "stand"]
    return from_target.select(*columns).unionByName(from_stand.select(*columns))


# --- folding ----------------------------------------------------------------------

# Rows of one block come in this order of ``kind``; ``a`` and ``b`` are what the kind says.
STATE, STAND, LINK, MOVE = 0, 1, 2, 3   # (thief, policeman), (node, role), (target, stand), (target, -)
ROW = ["game_id", "round", "block", "kind", "seq", "user", "a", "b", "sink", "valuable", "link", "turn", "verdict"]
STATUS_SCHEMA = ("game_id long, seq long, round long, user string, target long, status string, "
                 "thief_node long, police_node long")
MAP_SCHEMA = ("game_id long, round long, idx long, t long, p long, turn string, "
              "end_t long, end_p long, end_turn string, end_verdict string")


def _rows(df: DataFrame, kind: int, **columns) -> DataFrame:
    types = dict(seq="long", user="string", a="long", b="long", sink="boolean", valuable="boolean", link="int",
                 turn="string", verdict="string")
    return df.select("game_id", "round", "block", F.lit(kind).alias("kind"),
                     *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("game_id", "round", "block").sortWithinPartitions("game_id", "round", "block", "kind", "seq").select(*ROW)


def _each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Statuses of all moves; a block's state row and links come before its moves."""
    names = [f.split()[0] for f in STATUS_SCHEMA.split(", ")]
    block, state, links, out = None, None, {}, []
    for game, rnd, no, kind, seq, user, a, b, sink, valuable, link, turn, verdict in _each_row(batches):
        if (game, rnd, no) != block:
            block, links = (game, rnd, no), {}
        if kind == STATE:
            state = [a, b, turn, verdict]
        elif kind == LINK:
            links[a, b] = min(link, links.get((a, b), link))
        else:
            who = user.lower() if user else user
            status = RESTART if who == RESTART else adjudicate(
                state, who, a, sink, valuable, links.get((a, state[0] if who == C.THIEF else state[1]), 0))
            out.append((game, seq, rnd, user, a, status, state[0], state[1]))
            if len(out) >= 10_000:
                yield _batch(out, names)
                out = []
    if out:
        yield _batch(out, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = {"user": pa.string(), "status": pa.string(), "turn": pa.string(), "end_turn": pa.string(), "end_verdict": pa.string(),
             "verdict": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(list(c), types.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names=names)


class _BlockMap:
    """The moves of one block applied to many start states at once."""

    def __init__(self, states: list[tuple], stands: list[tuple], links: dict, moves: list[tuple]):
        if not states:  # any pair of stands may be the start
            thief, police = ([n for n, role in stands if role == r] for r in (0, 1))
            states = [(t, p, turn) for t in thief for p in police for turn in (C.THIEF, C.POLICEMAN)]
        self.states, self.moves = states, moves
        nodes = sorted({n for s in states for n in s[:2]} | {m[1] for m in moves}, key=lambda n: (n is not None, n))
        self.nodes, number = nodes, {n: i for i, n in enumerate(nodes)}
        self.target = {n: i for i, n in enumerate(sorted({m[1] for m in moves if m[1] is not None}))}
        self.link = np.zeros((len(self.target), len(nodes)), np.int8)
        for (a, b), how in links.items():
            if a in self.target and b in number:
                self.link[self.target[a], number[b]] = how
        self.number = number
        self.t, self.p = (np.array([number[s[k]] for s in states], np.int64) for k in (0, 1))
        self.police_turn = np.array([s[2] == C.POLICEMAN for s in states], bool)
        self.verdict = np.zeros(len(states), np.int8)  # 0: none, else place in VERDICTS + 1
        self.now = np.arange(len(states))              # start state -> present state

    def _merge(self) -> None:
        """States that have become equal go on as one."""
        key = ((self.t * len(self.nodes) + self.p) * 2 + self.police_turn) * (len(VERDICTS) + 1) + self.verdict
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        self.now = which[self.now]
        self.t, self.p, self.police_turn, self.verdict = self.t[first], self.p[first], self.police_turn[first], self.verdict[first]

    def run(self) -> Iterator[tuple]:
        for i, (who, target, sink, valuable) in enumerate(self.moves):
            if who in (C.THIEF, C.POLICEMAN):
                self._move(who == C.POLICEMAN, target, sink, valuable)
            if i % 16 == 0:
                self._merge()
        for s, e in zip(self.states, self.now.tolist()):
            v = int(self.verdict[e])
            yield (*s, self.nodes[self.t[e]], self.nodes[self.p[e]], C.POLICEMAN if self.police_turn[e] else C.THIEF,
                   VERDICTS[v - 1] if v else None)

    def _move(self, police: bool, target, sink: bool, valuable: bool) -> None:
        code = {v: i + 1 for i, v in enumerate(VERDICTS)}
        live = self.verdict == 0
        same = (self.t == self.p) & (self.t != self.number.get(None, -1))
        if police:
            self.verdict[live & same] = code["policeman_wins"]
            live &= ~same
        if target is None:
            return
        mine = live & (self.police_turn == police)
        link = self.link[self.target[target], self.p if police else self.t]
        self.verdict[mine & (link == PERTURBED_ONLY)] = code["policeman_illegal" if police else "thief_illegal"]
        moved, to = mine & (link == ADJACENT), self.number[target]
        if police:
            caught = moved & (self.t == to)
            self.p[moved] = to
            self.verdict[caught] = code["policeman_wins"]
            ended = caught | moved if sink else caught
            self.verdict[ended & ~caught] = code["policeman_no_moves"]
        else:
            self.t[moved] = to
            ended = moved if valuable or sink else np.zeros(len(moved), bool)
            self.verdict[ended] = code["thief_wins" if valuable else "thief_no_moves"]
        self.police_turn[moved & ~ended] = not police


def _map_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block its map: start state -> state after its last move."""
    names = [f.split()[0] for f in MAP_SCHEMA.split(", ")]
    block, states, stands, links, moves = None, [], [], {}, []

    def close() -> Iterator[pa.RecordBatch]:
        out = [(*block, *row) for row in _BlockMap(states, stands, links, moves).run()] if block else []
        for i in range(0, len(out), 50_000):
            yield _batch(out[i:i + 50_000], names)

    for game, rnd, no, kind, _seq, user, a, b, sink, valuable, link, turn, _verdict in _each_row(batches):
        if (game, rnd, no) != block:
            yield from close()
            block, states, stands, links, moves = (game, rnd, no), [], [], {}, []
        if kind == STATE:
            states.append((a, b, turn))
        elif kind == STAND:
            stands.append((a, b))
        elif kind == LINK:
            links[a, b] = min(link, links.get((a, b), link))
        else:
            moves.append((user.lower() if user else user, a, sink, valuable))
    yield from close()


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One map for each run of ``FAN`` neighbouring maps; rows come by run and place in it."""
    names = [f.split()[0] for f in MAP_SCHEMA.split(", ")]
    run, idx, reached, now = None, None, {}, {}

    def close() -> Iterator[pa.RecordBatch]:
        step()
        out = [(*run, *s, *e) for s, e in reached.items()] if run else []
        for i in range(0, len(out), 50_000):
            yield _batch(out[i:i + 50_000], names)

    def step() -> None:
        """Follow the map that has been read; its first one in a run says where the run can start."""
        if not reached:
            reached.update(now)
        else:
            for s, e in reached.items():
                if e[3] is None:
                    reached[s] = now[e[:3]]

    for game, rnd, run_no, i, t, p, turn, *end in _each_row(batches):
        if (game, rnd, run_no) != run:
            yield from close()
            run, idx, reached, now = (game, rnd, run_no), i, {}, {}
        elif i != idx:
            step()
            idx, now = i, {}
        now[t, p, turn] = tuple(end)
    yield from close()


def _start_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the start of each map of a run; the run's own start state comes first (``idx`` -1)."""
    names = ["game_id", "round", "idx", "t", "p", "turn", "verdict"]
    idx, run, state, out, following = None, None, None, [], None
    for game, rnd, run_no, i, t, p, turn, *end in _each_row(batches):
        if (game, rnd, run_no) != run:
            run, idx, state, following = (game, rnd, run_no), None, None, None
        if i < 0:
            state = (t, p, turn, end[3])
            continue
        if i != idx:
            if following is not None:
                state, following = following, None
            out.append((game, rnd, i, *state))
            idx = i
            if len(out) >= 10_000:
                yield _batch(out, names)
                out = []
        if state[3] is not None:
            following = state
        elif (t, p, turn) == state[:3]:
            following = tuple(end)
    if out:
        yield _batch(out, names)


def _by_run(maps: DataFrame) -> DataFrame:
    cols = ["t", "p", "turn", "end_t", "end_p", "end_turn", "end_verdict"]
    with_run = maps.select("game_id", "round", F.expr(f"idx div {FAN}").alias("run"), "idx", *cols)
    return with_run


def _sorted_runs(rows: DataFrame) -> DataFrame:
    return rows.repartition("game_id", "round", "run").sortWithinPartitions("game_id", "round", "run", "idx")


def _scan(maps: DataFrame, place: DataFrame, blocks: int) -> DataFrame:
    """``(game_id, round, idx, t, p, turn, verdict)``: the state at the start of every block of the long rounds."""
    levels = [maps]
    size = blocks
    while size > 1:
        size = -(-size // FAN)
        levels.append(cut_lineage(_sorted_runs(_by_run(levels[-1])).mapInArrow(_compose, MAP_SCHEMA)))
    known = (levels[-1].select("game_id", "round").distinct().join(place, ["game_id", "round"])
             .select("game_id", "round", F.lit(0).cast("long").alias("idx"), F.col("thief_start").alias("t"),
                     F.col("police_start").alias("p"), F.lit(C.THIEF).alias("turn"), F.col("placement_verdict").alias("verdict")))
    for level in reversed(levels[:-1]):
        first = known.select("game_id", "round", F.col("idx").alias("run"), F.lit(-1).cast("long").alias("idx"), "t", "p", "turn",
                             F.lit(None).cast("long").alias("end_t"), F.lit(None).cast("long").alias("end_p"),
                             F.lit(None).cast("string").alias("end_turn"), F.col("verdict").alias("end_verdict"))
        known = cut_lineage(_sorted_runs(_by_run(level).unionByName(first)).mapInArrow(
            _start_states, "game_id long, round long, idx long, t long, p long, turn string, verdict string"))
    return known


def replay(moves: DataFrame, nodes: DataFrame, edges: DataFrame, p_edges: DataFrame | None = None,
           illegal_loses: bool = False, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """M4: returns ``(statuses, outcomes)``.

    statuses: one row per move ``(game_id, seq, round, user, target, status,
    thief_node, police_node)`` (positions after the move); outcomes: one row
    per (game, round) with placement, final verdict and final positions.

    ``illegal_loses`` needs ``p_edges``, the perturbed board. ``block`` is how many moves of a game one task
    folds at a time; the result does not depend on it. The work on a round that is longer than a block grows
    with the number of its moves times the pairs of distinct nodes on which its players can stand, less what
    merges; rounds of one block are folded from their one start state.
    """
    if illegal_loses and p_edges is None:
        raise ValueError("illegal_loses needs the edges of the perturbed board")
    share_package(moves.sparkSession)
    facts = cut_lineage(node_facts(nodes, edges))
    numbered = _numbered(moves).withColumn("block", F.expr(f"(_no - 1) div {block}"))
    known = facts.select(F.col("node").alias("target"), F.lit(True).alias("on_board"), "sink", "valuable")
    mv = cut_lineage(numbered.join(known, "target", "left").select(
        "game_id", "round", "block", "seq", "user", F.lower("user").alias("who"), "target", F.coalesce("on_board", F.lit(False)).alias("on_board"),
        F.coalesce("sink", F.lit(False)).alias("sink"), F.coalesce("valuable", F.lit(False)).alias("valuable")))
    place = cut_lineage(placement(mv, facts))
    key = ["game_id", "round"]

    players = mv.where(F.col("who").isin(C.THIEF, C.POLICEMAN) & F.col("on_board"))
    role = F.when(F.col("who") == C.THIEF, 0).otherwise(1)
    # a player can stand where the round puts it or on a target that does not end the game
    roles = (players.where(~F.col("sink") & ~(F.col("valuable") & (F.col("who") == C.THIEF))).select(*key, F.col("target").alias("stand"), role.alias("role"))
             .unionByName(place.select(*key, F.col("thief_start").alias("stand"), F.lit(0).alias("role")))
             .unionByName(place.select(*key, F.col("police_start").alias("stand"), F.lit(1).alias("role")))).distinct()
    stands = roles.select(*key, "stand").distinct()
    targets = players.select(*key, "block", "target").distinct()
    links = _links(targets, stands, edges).withColumn("link", F.lit(ADJACENT))
    if illegal_loses:
        links = links.unionByName(_links(targets, stands, p_edges).withColumn("link", F.lit(PERTURBED_ONLY)))
    board = _rows(links, LINK, a=F.col("target"), b=F.col("stand"), link=F.col("link"))
    steps = _rows(mv, MOVE, seq=F.col("seq"), user=F.col("user"), a=F.col("target"), sink=F.col("sink"), valuable=F.col("valuable"))

    cuts = mv.groupBy(*key).agg(F.min("block").alias("first"), F.max("block").alias("last"))
    first = place.join(cuts, key).withColumn("block", F.col("first"))
    start = _rows(first, STATE, a=F.col("thief_start"), b=F.col("police_start"), turn=F.lit(C.THIEF), verdict=F.col("placement_verdict"))
    long_rounds = cuts.where("last > first")
    longest = long_rounds.agg(F.max(F.col("last") - F.col("first"))).first()[0]
    if longest is not None:
        board, steps = cut_lineage(board), cut_lineage(steps)
        keys_of = long_rounds.select(*key)
        inside = lambda df: df.join(keys_of, key, "left_semi")
        later = long_rounds.select(*key, F.explode(F.expr("sequence(first + 1, last)")).alias("block"))
        may_stand = _rows(later.join(roles, key), STAND, a=F.col("stand"), b=F.col("role"))
        maps = _dealt(inside(start).unionByName(inside(board)).unionByName(inside(steps)).unionByName(may_stand)).mapInArrow(
            _map_blocks, MAP_SCHEMA)
        maps = cut_lineage(maps.join(long_rounds, key).withColumn("idx", F.col("idx") - F.col("first")).drop("first", "last"))
        states = _scan(maps, place, longest + 1)
        more = states.where("idx > 0").join(long_rounds, key).withColumn("block", F.col("first") + F.col("idx"))
        start = start.unionByName(_rows(more, STATE, a=F.col("t"), b=F.col("p"), turn=F.col("turn"), verdict=F.col("verdict")))
    statuses = _dealt(start.unionByName(board).unionByName(steps)).mapInArrow(_fold_blocks, STATUS_SCHEMA)

    ended = F.when(F.col("status").isin(*VERDICTS), F.col("status"))
    final = statuses.groupBy(*key).agg(F.max(ended).alias("verdict"), F.count(F.lit(1)).alias("n_moves"),
                                       F.max_by(F.struct("thief_node", "police_node"), "seq").alias("at"))
    outcomes = (place.join(final, key)
                .select(*key, "thief_start", "police_start", "placement_verdict",
                        F.coalesce("placement_verdict", "verdict", F.lit("open")).alias("outcome"),
                        F.when(F.col("placement_verdict").isNotNull(), F.lit("placement"))
                        .when(F.col("verdict").isNotNull(), F.lit("play")).alias("decided_at"),
                        F.col("at.thief_node").alias("thief_node"), F.col("at.police_node").alias("police_node"),
                        F.col("n_moves").cast("bigint").alias("n_moves")))
    return statuses, outcomes


def latest_positions(outcomes: DataFrame) -> DataFrame:
    """M5: final node of each player of the last round of each game."""
    outcomes = cut_lineage(outcomes)  # read twice; comes from the fold of all moves
    last = outcomes.groupBy("game_id").agg(F.max("round").alias("round"))
    o = outcomes.join(last, ["game_id", "round"])
    t = o.select("game_id", F.lit(C.THIEF).alias("role"), F.col("thief_node").alias("node"))
    p = o.select("game_id", F.lit(C.POLICEMAN).alias("role"), F.col("police_node").alias("node"))
    return t.unionByName(p)


def turn_audit(moves: DataFrame) -> DataFrame:
    """M3: moves made by the same player as the previous row of the game.

    The previous row is found with an equi-join on ``(game_id, seq - 1)``
    rather than a window, so a huge game is not sorted in one task.
    """
    prev = moves.select("game_id", (F.col("seq") + 1).alias("seq"), F.lower("user").alias("prev_user"))
    j = moves.join(prev, ["game_id", "seq"], "left")
    return j.select("game_id", "seq", F.lower("user").alias("user"), "prev_user",
                    F.coalesce(F.lower("user") == F.col("prev_user"), F.lit(False)).alias("repeated"))
