"""Hard-negative mining by exact integer products of anchor and candidate tiles.

Scores are inner products of integer vectors. A cell holds a block of anchors and
streams its group of candidates past it, tile by tile; a tile product is a Strassen
recursion on int64 matrices, padded with zeros to even sides, whose additions are
exact modulo 2^64 and so exact for every score that fits a long.

Two rounds use the same cells. The first meets anchors with rows of their own label
only and keeps a heap of the best positives of each anchor. The second meets anchors,
which now carry their positives, with all rows of other labels and keeps, for each
positive, a heap of the best scores inside the positive's window. Heaps of a tile are
merged into the heaps of the cell, and the heaps of cells by a ranking in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, positive_partitions

ANCHORS = 8192   # anchors of a cell, on average; a cell holds them in memory
GROUP = 16384    # candidates of a cell, on average; they are streamed
SALT = 32        # shares of a part while its rows learn how many cells it has
TILE = (256, 2048)
LEAF = 32        # sides up to this are multiplied directly
NONE = -(2**63 - 1)  # score of an empty heap place; real scores are kept above it
NO_ID = 2**63 - 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` with seven products a level; odd sides are padded with a zero row or column."""
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    x, y, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:x, :y], a[:x, y:], a[x:, :y], a[x:, y:]
    b11, b12, b21, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * x, 2 * z), a.dtype)
    out[:x, :z], out[:x, z:] = p1 + p4 - p5 + p7, p3 + p5
    out[x:, :z], out[x:, z:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def tile_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` as int64; scores beyond a long are held at its ends."""
    peak = [max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0 for x in (a, b)]
    if peak[0] * peak[1] * max(a.shape[1], 1) < 2**63 - 1:
        return strassen(a, np.ascontiguousarray(b.T))
    wide = strassen(a.astype(object), b.astype(object).T)
    return np.minimum(np.maximum(wide, NONE + 1), -NONE).astype(np.int64)


def merge_heaps(score: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best places of two heaps along the last axis: higher scores first, then smaller ids."""
    s, i = np.concatenate((score, more), axis=-1), np.concatenate((ids, more_ids), axis=-1)
    top = np.lexsort((i, -s), axis=-1)[..., :score.shape[-1]]
    return np.take_along_axis(s, top, -1), np.take_along_axis(i, top, -1)


class PositiveHeaps:
    """The ``k`` best rows of each anchor's own label."""

    schema = "anchor long, row long, score long"

    def __init__(self, anchors: pa.Table, ids: np.ndarray, labels: np.ndarray, k: int):
        self.anchors, self.score = ids, np.full((len(ids), k), NONE, np.int64)
        self.row = np.full((len(ids), k), NO_ID, np.int64)

    def add(self, at: slice, s: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        s = np.where(ids[None, :] == self.anchors[at, None], NONE, s)
        top = np.argsort(-s, axis=1, kind="stable")[:, :self.score.shape[1]]  # candidates come by id
        best = np.take_along_axis(s, top, 1)
        self.score[at], self.row[at] = merge_heaps(self.score[at], self.row[at], best,
                                                   np.where(best > NONE, ids[top], NO_ID))

    def found(self) -> list[np.ndarray]:
        there = self.score > NONE
        return [np.repeat(self.anchors, there.sum(axis=1)), self.row[there], self.score[there]]


class WindowHeaps:
    """For each anchor and positive the ``k`` best rows of other labels inside the positive's window."""

    schema = "anchor long, positive long, positive_score long, row long, score long"

    def __init__(self, anchors: pa.Table, ids: np.ndarray, labels: np.ndarray, k: int):
        col = anchors["positives"].combine_chunks()
        sizes = np.asarray(pc.list_value_length(col), np.int64)
        flat = col.flatten()
        width = int(sizes.max())
        place = (np.repeat(np.arange(len(ids)), sizes), np.concatenate([np.arange(n) for n in sizes]))
        self.positive, self.pscore = np.full((len(ids), width), NO_ID, np.int64), np.full((len(ids), width), -1, np.int64)
        self.positive[place] = pc.struct_field(flat, "row").to_numpy()
        self.pscore[place] = pc.struct_field(flat, "score").to_numpy()
        self.lowest = -(-self.pscore // 2)                    # the least n with 50 p <= 100 n
        self.highest = self.pscore + (-self.pscore // 20)     # the greatest n with 100 n <= 95 p
        self.lowest[self.pscore < 0], self.highest[self.pscore < 0] = 0, -1  # an empty window
        self.anchors, self.labels = ids, labels
        self.score = np.full((len(ids), width, k), NONE, np.int64)
        self.row = np.full((len(ids), width, k), NO_ID, np.int64)

    def add(self, at: slice, s: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        k = self.score.shape[2]
        s = np.where((s < 0) | (labels[None, :] == self.labels[at, None]), NONE, s)  # windows hold no negative score
        order = np.argsort(-s, axis=1, kind="stable")
        ranked = np.take_along_axis(s, order, 1)
        low, high = self.lowest[at], self.highest[at]
        first = np.stack([(s > high[:, j, None]).sum(axis=1) for j in range(high.shape[1])], axis=1)
        places = first[:, :, None] + np.arange(k)
        inside = places < s.shape[1]
        places = np.where(inside, places, 0).reshape(len(s), -1)
        best = np.take_along_axis(ranked, places, 1).reshape(first.shape + (k,))
        rows = ids[np.take_along_axis(order, places, 1)].reshape(first.shape + (k,))
        good = inside & (best >= low[:, :, None]) & (best <= high[:, :, None])
        self.score[at], self.row[at] = merge_heaps(self.score[at], self.row[at], np.where(good, best, NONE),
                                                   np.where(good, rows, NO_ID))

    def found(self) -> list[np.ndarray]:
        there = self.score > NONE
        whose, which = np.nonzero(there)[:2]
        return [self.anchors[whose], self.positive[whose, which], self.pscore[whose, which], self.row[there], self.score[there]]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(column), width)


def _mine_cells(cells: DataFrame, heaps: type, k: int) -> DataFrame:
    """Run the cells: rows of one cell come together, its anchors first, candidates by id."""
    spark = cells.sparkSession
    key = ["part", "width", "g", "b"]
    dealt = cells.repartition(4 * positive_partitions(spark), *key).sortWithinPartitions(*key, "kind", "id")
    names = [f.split()[0] for f in heaps.schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, state = None, [], None

        def close() -> Iterator[pa.RecordBatch]:
            if state is not None and len((found := state[0].found())[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)

        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in [*key, "kind"]], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                if start == end:
                    continue
                part, cell, kind = batch.slice(start, end - start), tuple(keys[start, :4]), keys[start, 4]
                if cell != current:
                    yield from close()
                    current, held, state = cell, [], None
                if kind == 0:
                    held.append(part)
                    continue
                if state is None and held:
                    anchors = pa.Table.from_batches(held)
                    ids, labels = anchors["id"].to_numpy(), anchors["label"].to_numpy()
                    state = heaps(anchors, ids, labels, k), _matrix(anchors["v"].combine_chunks(), cell[1])
                    held = []
                if state is not None:
                    _stream(*state, part, cell[1])
        yield from close()

    return dealt.mapInArrow(run, heaps.schema)


def _stream(heap, m: np.ndarray, rows: pa.RecordBatch, width: int) -> None:
    """Score a batch of candidates against all anchors of the cell, tile by tile."""
    ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
    v = _matrix(rows.column("v"), width)
    for a in range(0, len(ids), TILE[1]):
        to = slice(a, a + TILE[1])
        for b in range(0, len(m), TILE[0]):
            at = slice(b, b + TILE[0])
            heap.add(at, tile_scores(m[at], v[to]), ids[to], labels[to])


def _spread(to, salt: int):
    return F.pmod(F.xxhash64("id", F.lit(salt)), to).cast("int")


def _every(to):
    return F.explode(F.sequence(F.lit(0), to.cast("int") - 1))


def _cells(anchors: DataFrame, rows: DataFrame, part, group: int, block: int) -> DataFrame:
    """Deal anchors in blocks and rows in groups of their ``part``; each block meets each group once.

    The numbers of blocks and groups follow the counts of a part, so a label that holds most rows is
    many cells. Parts without anchors or without rows have no cell.
    """
    counts = (rows.select(part.alias("part"), F.size("v").alias("width"), F.lit(1).alias("r"), F.lit(0).alias("a"))
              .unionByName(anchors.select(part.alias("part"), F.size("v").alias("width"), F.lit(0).alias("r"), F.lit(1).alias("a")))
              .groupBy("part", "width").agg(F.ceil(F.sum("r") / group).alias("groups"), F.ceil(F.sum("a") / block).alias("blocks"))
              .where("groups > 0 and blocks > 0").withColumn("salt", _every(F.lit(SALT))))
    with_part = lambda df: (df.select(part.alias("part"), F.size("v").alias("width"), _spread(F.lit(SALT), 3).alias("salt"), "*")
                            .join(counts, ["part", "width", "salt"]))
    front = with_part(anchors).select("part", "width", _every(F.col("groups")).alias("g"), _spread(F.col("blocks"), 1).alias("b"),
                                      F.lit(0).alias("kind"), *anchors.columns)
    back = with_part(rows).select("part", "width", _spread(F.col("groups"), 2).alias("g"), _every(F.col("blocks")).alias("b"),
                                  F.lit(1).alias("kind"), *rows.columns)
    return front.unionByName(back, allowMissingColumns=True)


def mine(df: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, vec_id: str = "vec_id", label: str = "label",
         vector: str = "vector", group: int = GROUP, block: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``df`` holds a long id, an integer label and an array of longs. ``is_anchor`` is a condition on ``df``.
    An anchor's positives are its ``positives`` best other rows of its label; for each of them the
    ``negatives`` best rows of other labels with ``50 * positive_score <= 100 * negative_score <=
    95 * positive_score`` are returned, ties by smaller id, all if there are fewer.

    Rows with a null id, label, vector or component take no part. Of rows that share an id the one with
    the smallest label, then vector, takes part, so equal rows are one. Vectors of different length do not
    meet; empty vectors score 0 with each other. Scores beyond a long are held at its ends. A positive of
    negative score has an empty window. Other columns are ignored; an empty table gives no rows.
    """
    named = df.select(df[vec_id].cast("long").alias("id"), df[label].cast("long").alias("label"), df[vector].alias("v"),
                      F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    whole = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                        & ~F.exists("v", lambda x: x.isNull()))
    rows, _ = materialise(whole.groupBy("id").agg(F.min(F.struct("label", "v", "is_anchor")).alias("r")).select("id", "r.*"),
                          "negative-rows")
    anchors, rows = rows.where("is_anchor").drop("is_anchor"), rows.drop("is_anchor")

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "row")
    own = _mine_cells(_cells(anchors, rows, F.col("label"), group, block), PositiveHeaps, positives)
    own = own.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    own, _ = materialise(own.groupBy(F.col("anchor").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("n", "row", "score"))).alias("positives")), "positives")

    armed = anchors.join(own, "id")
    other = _mine_cells(_cells(armed, rows, F.lit(0).cast("long"), group, block), WindowHeaps, negatives)
    best = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "row")
    return other.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("row").alias("negative_id"),
        F.col("positive_score"), F.col("score").alias("negative_score"))


def shift_labels(label, vec_id, classes: int = 10, every: int = 7):
    """The label that a row counts under: ids divisible by ``every`` go to the next class."""
    return F.when(vec_id % every == 0, (label + 1) % classes).otherwise(label)
