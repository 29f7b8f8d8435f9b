"""Exact top-k inner products by block-at-a-time pruning.

Vectors are quantised to integers; a dimension is a term. Rows lie in fixed
groups, ordered inside by their leading terms and cut into document-range blocks.
A block keeps the largest and smallest value of every term and its forward index
(the integer matrix). For each query the blocks are ordered by the sum of their
term maxima and scored in that order until the next bound is below the k-th score.
Groups of rows meet blocks of queries as keyed cells; the cells' best rows are
merged by a final ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import positive_partitions

GROUP = 16384   # rows of a group, on average
QUERIES = 8192  # queries of a query block, on average
BLOCK = 128     # rows of a document-range block
EXACT = float(1 << 53)


def quantised(vector, scale: int = 1024):
    """floor(scale * x) of every component as long; null for a vector that takes no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), whole)


def _block_order(m: np.ndarray) -> np.ndarray:
    """Rows sorted by the signs of the terms that spread most: rows of a block are alike."""
    if not m.shape[1]:
        return np.arange(len(m))
    strong = np.argsort(-m.std(axis=0), kind="stable")[:16]
    return np.lexsort((m[:, strong] >= np.median(m[:, strong], axis=0)).T[::-1])


class BlockIndex:
    """Blocks of one group of rows, all of one dimension."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        order = _block_order(m)
        self.ids, self.m = ids[order], m[order]
        self.cuts = np.append(np.arange(0, len(ids), BLOCK), len(ids))
        self.high = np.array([self.m[a:b].max(axis=0) for a, b in zip(self.cuts, self.cuts[1:])])
        self.low = np.array([self.m[a:b].min(axis=0) for a, b in zip(self.cuts, self.cuts[1:])])

    def best(self, qids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query id, row id, score) arrays of each query's k best rows here, itself left out."""
        bound = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        order = np.argsort(-bound, axis=1, kind="stable")
        ranked = np.take_along_axis(bound, order, axis=1)
        score = np.full((len(q), k), -np.inf)
        row = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
        active = np.arange(len(q))
        for step in range(order.shape[1]):
            # a bound equal to the k-th score may still bring a smaller id
            active = active[ranked[active, step] >= score[active, -1]]
            if not len(active):
                break
            turn = active[np.argsort(order[active, step], kind="stable")]
            blocks = order[turn, step]
            edges = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1], [True])))
            for a, b in zip(edges, edges[1:]):
                who, at = turn[a:b], slice(self.cuts[blocks[a]], self.cuts[blocks[a] + 1])
                fresh = q[who] @ self.m[at].T
                ids = np.broadcast_to(self.ids[at], fresh.shape)
                fresh[ids == qids[who][:, None]] = -np.inf
                s, i = np.hstack((score[who], fresh)), np.hstack((row[who], ids))
                i = np.where(np.isneginf(s), np.iinfo(np.int64).max, i)
                top = np.lexsort((i, -s), axis=1)[:, :k]
                score[who], row[who] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
        found = ~np.isneginf(score)
        yield np.repeat(qids, found.sum(axis=1)), row[found], score[found]


def _exact_dtype(*mats: np.ndarray):
    """Matrices as float64 where every score is exact in it, else as Python integers."""
    peak = [max((abs(int(m.max())), abs(int(m.min())))) if m.size else 0 for m in mats]
    width = mats[0].shape[1]
    return np.float64 if peak[0] * peak[1] * max(width, 1) < EXACT else object


def _plain_best(ids, m, qids, q, k):
    """Scores beyond 2^53: the same ranking with unbounded integers, row by row, kept within a long."""
    for qid, vec in zip(qids.tolist(), q.astype(object)):
        s = [(-max(-(1 << 63), min((1 << 63) - 1, int(x))), i) for x, i in zip(m.astype(object) @ vec, ids.tolist()) if i != qid]
        top = sorted(s)[:k]
        yield np.full(len(top), qid, np.int64), np.array([i for _, i in top], np.int64), np.array([-x for x, _ in top], object)


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "vector",
          group: int = GROUP, query_block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows of ``df``, all if fewer.

    Both tables hold a long id and an array of longs; null vectors and null ids take no part,
    rows that share an id come out each, a row never answers a query of its own id, ties go to the smaller id, and vectors of
    different length do not meet. Every row is scored or bounded: nothing is sampled.
    Empty tables give no rows; other columns are ignored.
    """
    spark = df.sparkSession
    n = positive_partitions(spark)
    rows = df.where(df[vector].isNotNull() & df[vec_id].isNotNull()).select(df[vec_id].cast("long").alias("id"), df[vector].alias("v"))
    asks = queries.where(queries[vector].isNotNull() & queries[vec_id].isNotNull()).select(queries[vec_id].cast("long").alias("id"), queries[vector].alias("v"))
    n_rows, n_asks = rows.count(), asks.count()
    groups, blocks = max(1, -(-n_rows // group)), max(1, -(-n_asks // query_block))
    spread = lambda to, salt: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(to)).cast("int")
    every = lambda to: F.explode(F.sequence(F.lit(0), F.lit(to - 1)))
    cells = (rows.select(spread(groups, 1).alias("g"), every(blocks).alias("b"), F.lit(0).alias("kind"), "id", "v")
             .unionByName(asks.select(every(groups).alias("g"), spread(blocks, 2).alias("b"), F.lit(1).alias("kind"), "id", "v"))
             .repartition(min(groups * blocks, 4 * n) if groups * blocks > 1 else 1, "g", "b")
             .sortWithinPartitions("g", "b", "kind", "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            key = b.column("g").to_numpy() * blocks + b.column("b").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            for a, z in zip(cuts, cuts[1:]):
                if z > a:
                    if held and (held[0].column("g")[0], held[0].column("b")[0]) != (b.column("g")[a], b.column("b")[a]):
                        yield from cell(held)
                        held = []
                    held.append(b.slice(a, z - a))
        if held:
            yield from cell(held)

    def cell(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        kind, ids = t["kind"].to_numpy(), t["id"].to_numpy()
        lens = pc.list_value_length(t["v"]).to_numpy()
        flat = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lens) - lens
        for width in np.unique(lens[kind == 1]).tolist():
            have, ask = np.flatnonzero((kind == 0) & (lens == width)), np.flatnonzero((kind == 1) & (lens == width))
            if not len(have) or not len(ask):
                continue
            at = lambda i: flat[starts[i][:, None] + np.arange(width)]
            m, q = at(have), at(ask)
            if _exact_dtype(m, q) is np.float64:
                found = BlockIndex(ids[have], m.astype(np.float64)).best(ids[ask], q.astype(np.float64), k)
            else:
                found = _plain_best(ids[have], m, ids[ask], q, k)
            for qid, rid, score in found:
                yield pa.RecordBatch.from_arrays([pa.array(qid), pa.array(rid), pa.array(score.astype(np.int64))],
                                                 names=["query_id", "vec_id", "score"])

    best = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
