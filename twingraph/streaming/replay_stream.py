"""Structured Streaming move replay (M11) and windowed move counts.

M11 runs in two stateful steps over a stream of moves with event time ``ts``.

* :func:`ordered_moves` puts the moves of a game in ``seq`` order. Rows that arrive
  ahead of a gap wait in a map state, at most ``wait`` of event time: a timer then
  reports the missing numbers in one row and releases what waited behind them. A row
  that comes again is reported as ``duplicate``, one that comes after its number was
  given up as ``late``; neither is applied. ``round`` counts the restarts so far.
* :func:`stream_replay` joins the ordered moves with the static board (facts and
  neighbours of the target, start positions of the round) and folds them game by game
  by the rule of :mod:`twingraph.operators.replay`; the state of a game is one row.

Both steps use ``transformWithStateInPandas``, which needs the RocksDB state store.

M12: ``withWatermark`` + ``window`` counts per player; rows later than the
watermark are dropped by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import constants as C
from ..operators.graph import undirected
from ..operators.kernel import cut_lineage, prefix_rank
from ..operators.replay import ADJACENT, PERTURBED_ONLY, RESTART, adjudicate, node_facts
from ..session import share_package

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WAIT_MINUTES = 24 * 60
WATERMARK = "1 day"
WAIT_BLOCK = 256  # numbers of a game whose waiting rows are one entry of the state
#: What :func:`ordered_moves` reports beside moves.
REPORTS = ("missing", "late", "duplicate")

ORDERED_SCHEMA = ("game_id long, seq long, ts timestamp, round long, user string, target long, kind string, n_missing long, "
                  "released timestamp")
STATUS_SCHEMA = ("game_id long, seq long, round long, user string, target long, status string, "
                 "thief_node long, police_node long, n_missing long")


def use_rocksdb(spark: SparkSession) -> None:
    """Choose the state store that keyed maps and timers need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


class _Order(StatefulProcessor):
    """Releases the rows of a game in ``seq`` order, 1 upwards.

    A call to the state store costs more than a row, so rows that follow on at once never go there, and
    waiting rows lie in blocks of ``WAIT_BLOCK`` numbers, each read and written once for a frame of rows.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.at = handle.getValueState("at", "next_seq long, round long, timer long, blocks long")
        self.waiting = handle.getMapState("waiting", "block long", "first_ms long, rows string")
        self.given_up = handle.getMapState("given_up", "first long", "last long")  # ranges of missing numbers
        self.open: dict[int, dict] = {}   # blocks in hand: seq -> (ts, user, target)
        self.stored: set[int] = set()     # those of them that are in the store
        self.blocks = 0                   # blocks in the store

    @staticmethod
    def _rows(text: str) -> dict:
        return {s: (pd.NaT if us is None else pd.Timestamp(us, unit="us"), user, target) for s, us, user, target in json.loads(text)}

    def _block(self, seq: int) -> dict:
        n = seq // WAIT_BLOCK
        if n not in self.open:
            found = self.waiting.getValue((n,)) if self.blocks else None
            self.open[n] = self._rows(found[1]) if found is not None else {}
            if found is not None:
                self.stored.add(n)
        return self.open[n]

    def _put_back(self) -> None:
        """Write the blocks in hand to the store, and remove those without rows."""
        for n, rows in self.open.items():
            if rows:
                text = json.dumps([(s, None if ts is pd.NaT else ts.value // 1000, user, target) for s, (ts, user, target) in rows.items()])
                self.waiting.updateValue((n,), (min(ts.value // 1_000_000 for ts, _, _ in rows.values()), text))
                self.blocks += n not in self.stored
            elif n in self.stored:
                self.waiting.removeKey((n,))
                self.blocks -= 1
        self.open, self.stored = {}, set()

    def _release(self, seq: int, rnd: int, floor_ms: int, rows: list) -> tuple[int, int]:
        """Move the rows that follow on without a gap from the waiting ones to ``rows``."""
        floor = pd.Timestamp(floor_ms, unit="ms")
        while (found := self._block(seq).pop(seq, None)) is not None:
            ts, user, target = found
            rows.append((seq, ts, rnd, user, target, "move", None, max(ts, floor)))
            rnd += (user or "").lower() == RESTART
            seq += 1
        return seq, rnd

    def _set_timer(self, old: int) -> int:
        """One timer a game, for the row that has waited longest; 0 for none."""
        first = min((v[0] for v in self.waiting.values()), default=None) if self.blocks else None
        due = 0 if first is None else first + self.wait_ms
        if old and old != due:
            self.handle.deleteTimer(old)
        if due and old != due:
            self.handle.registerTimer(due)
        return due

    def _frame(self, game: int, rows: list) -> pd.DataFrame:
        names = ["seq", "ts", "round", "user", "target", "kind", "n_missing", "released"]
        df = pd.DataFrame(rows, columns=names)
        df.insert(0, "game_id", game)
        for c in ("target", "n_missing"):
            df[c] = df[c].astype("Int64")
        for c in ("ts", "released"):
            df[c] = pd.to_datetime(df[c])
        return df

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seq, rnd, timer, self.blocks = self.at.get() or (1, 0, 0, 0)
        floor = max(timerValues.getCurrentWatermarkInMs(), 0)
        for pdf in rows:
            out: list[tuple] = []
            for s, ts, user, target in zip(pdf["seq"], pdf["ts"], pdf["user"], pdf["target"]):
                s, ts, user = int(s), pd.Timestamp(ts), user if isinstance(user, str) else None
                target = None if pd.isna(target) else int(target)
                if s >= seq and s not in self._block(s):
                    self._block(s)[s] = (ts, user, target)
                else:
                    kind = "late" if s < seq and any(a[0] <= s <= z[0] for a, z in self.given_up.iterator()) else "duplicate"
                    out.append((s, ts, None, user, target, kind, None, max(ts, pd.Timestamp(floor, unit="ms"))))
            seq, rnd = self._release(seq, rnd, floor, out)
            self._put_back()
            if out:
                yield self._frame(int(key[0]), out)
        timer = self._set_timer(timer)
        self.at.update((seq, rnd, timer, self.blocks))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seq, rnd, _, self.blocks = self.at.get()
        floor = max(timerValues.getCurrentWatermarkInMs(), 0)
        out: list[tuple] = []
        # every gap in front of a row that is overdue is given up
        late = [self._rows(text) for first, text in self.waiting.values() if first + self.wait_ms <= floor]
        overdue = sorted(s for held in late for s, v in held.items() if v[0].value // 1_000_000 + self.wait_ms <= floor)
        for s in overdue:
            if s > seq:
                self.given_up.updateValue((seq,), (s - 1,))
                out.append((seq, pd.Timestamp(floor, unit="ms"), rnd, None, None, "missing", s - seq, pd.Timestamp(floor, unit="ms")))
                seq = s
            if s == seq:
                seq, rnd = self._release(seq, rnd, floor, out)
        self._put_back()
        timer = self._set_timer(0)
        self.at.update((seq, rnd, timer, self.blocks))
        yield self._frame(int(key[0]), out)

    def close(self) -> None:
        pass


def ordered_moves(moves_stream: DataFrame, wait_minutes: int = WAIT_MINUTES, watermark: str = WATERMARK) -> DataFrame:
    """The moves of each game in ``seq`` order, with their round, and the reports ``missing``, ``late``, ``duplicate``.

    A waiting row is kept until the watermark has passed it by ``wait_minutes``, so the buffer is bounded by time.
    Rows behind the watermark do not get here: Spark drops them and counts them in the progress of the query.
    """
    spark = moves_stream.sparkSession
    use_rocksdb(spark)
    share_package(spark)
    rows = moves_stream.select("game_id", "seq", F.col("ts").cast("timestamp").alias("ts"), "user", "target")
    return (rows.withWatermark("ts", watermark).groupBy("game_id").transformWithStateInPandas(
        _Order(wait_minutes * 60_000), ORDERED_SCHEMA, "append", "EventTime", eventTimeColumnName="released"))


class _Fold(StatefulProcessor):
    """Applies ordered moves; a round starts from the positions that its rows carry."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "round long, t long, p long, turn string, verdict string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        plain = lambda x: None if x is None or x is pd.NA or x != x else int(x)
        held = list(self.state.get() or (-1, None, None, C.THIEF, None))
        pdf = pd.concat(list(rows)).sort_values(["seq", "kind"], kind="stable")
        out = []
        for r in pdf.itertuples(index=False):
            if r.kind != "move":
                out.append((int(r.seq), plain(r.round), r.user, plain(r.target), r.kind, None, None, plain(r.n_missing)))
                continue
            if int(r.round) != held[0]:
                held = [int(r.round), plain(r.thief_start), plain(r.police_start), C.THIEF, r.placement_verdict]
            state, target = held[1:], plain(r.target)
            user = r.user.lower() if r.user else r.user
            if user == RESTART:
                status = RESTART
            else:
                at = state[0] if user == C.THIEF else state[1]
                near = lambda nbrs: nbrs is not None and at is not None and at in nbrs
                link = ADJACENT if near(r.nbrs) else PERTURBED_ONLY if near(r.p_nbrs) else 0
                status = adjudicate(state, user, target, bool(r.sink), bool(r.valuable), link)
            held = [held[0], *state]
            out.append((int(r.seq), held[0], r.user, target, status, held[1], held[2], None))
        self.state.update(tuple(held))
        df = pd.DataFrame(out, columns=["seq", "round", "user", "target", "status", "thief_node", "police_node", "n_missing"])
        df.insert(0, "game_id", int(key[0]))
        for c in ("round", "target", "thief_node", "police_node", "n_missing"):
            df[c] = df[c].astype("Int64")
        yield df

    def close(self) -> None:
        pass


def _neighbours(edges: DataFrame, name: str) -> DataFrame:
    return undirected(edges).groupBy(F.col("node").alias("target")).agg(F.collect_list("nbr").alias(name))


def stream_replay(moves_stream: DataFrame, nodes: DataFrame, edges: DataFrame, p_edges: DataFrame | None = None,
                  illegal_loses: bool = False, wait_minutes: int = WAIT_MINUTES, watermark: str = WATERMARK) -> DataFrame:
    """Streaming statuses ``(game_id, seq, round, user, target, status, thief_node, police_node, n_missing)``.

    Beside the statuses of moves there are rows of status ``missing`` (``n_missing`` numbers from ``seq`` on were
    given up), ``late`` and ``duplicate``. The board is static; nothing of it is collected on the driver.
    """
    if illegal_loses and p_edges is None:
        raise ValueError("illegal_loses needs the edges of the perturbed board")
    facts = cut_lineage(node_facts(nodes, edges))
    near = cut_lineage(facts.withColumnRenamed("node", "target").join(_neighbours(edges, "nbrs"), "target", "left"))
    if illegal_loses:
        near = cut_lineage(near.join(_neighbours(p_edges, "p_nbrs"), "target", "left"))
    else:
        near = near.withColumn("p_nbrs", F.lit(None).cast("array<bigint>"))
    places = cut_lineage(prefix_rank(facts, [], ["node"], out="place"))
    n = F.lit(places.count() or None).cast("bigint")
    g, r = F.col("game_id"), F.col("round")
    ordered = (ordered_moves(moves_stream, wait_minutes, watermark)
               .withColumn("_t", F.pmod(g * 7 + r * 3 + 1, n)).withColumn("_p", F.pmod(g * 11 + r * 5 + 5, n)))
    thief = places.select(F.col("place").alias("_t"), F.col("node").alias("thief_start"), F.col("sink").alias("t_sink"), F.col("valuable").alias("t_val"))
    police = places.select(F.col("place").alias("_p"), F.col("node").alias("police_start"), F.col("sink").alias("p_sink"))
    verdict = (F.when(F.col("t_val"), "thief_wins").when(F.col("t_sink"), "thief_no_moves").when(F.col("p_sink"), "policeman_no_moves")
               .when(F.col("thief_start") == F.col("police_start"), "policeman_wins"))
    rows = (ordered.join(thief, "_t", "left").join(police, "_p", "left").join(near, "target", "left")
            .select("game_id", "seq", "round", "user", "target", "kind", "n_missing", "thief_start", "police_start",
                    verdict.alias("placement_verdict"), "nbrs", "p_nbrs", F.coalesce("sink", F.lit(False)).alias("sink"),
                    F.coalesce("valuable", F.lit(False)).alias("valuable")))
    return rows.groupBy("game_id").transformWithStateInPandas(_Fold(), STATUS_SCHEMA, "append", "None")


def moves_per_window(moves: DataFrame, minutes: int = C.WINDOW_MINUTES, watermark: str | None = None) -> DataFrame:
    """Moves per player and tumbling window; with ``watermark`` for streams."""
    src = moves.withColumn("ts", F.col("ts").cast("timestamp"))  # event time must be TIMESTAMP
    src = src.withWatermark("ts", watermark) if watermark else src
    agg = src.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), F.lower("user").alias("user")).agg(
        F.count(F.lit(1)).alias("n"))
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "user",
                      F.col("n").cast("bigint").alias("n"))
