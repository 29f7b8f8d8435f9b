"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector to the signs of random projections; a pass begins with
its own hash and goes on with those of the others, so the concatenated hashes order
all vectors of a label lexicographically. In that order every vector is compared
with its next ``WINDOW`` neighbours by double-precision cosine. Positions come from a
ranking that needs no label in one task; a block of ``BLOCK`` positions also gets
the last ``WINDOW`` rows before it, so windows go on across blocks. Only spanning
links leave a block, and the links of all passes are united by connected components.

A bounded window cannot see all links of a large group, so links are counted
afterwards inside each component: its vectors are cut into parts, every pair of parts
is a cell, and a cell passes on sums only, never its pairs. A pair of one component
counts even if no window held it. Equal vectors are one class with a count throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.kernel import prefix_rank
from .common import materialise, positive_partitions
from .components import connected_components
from .simhash import _Forest

PASSES = 8
WINDOW = 256   # neighbours after a vector that it is compared with in a pass
BLOCK = 2048   # positions of a block
PART = 1024    # vectors of a part of a component, on average
SALT = 8       # shares of the rows of one vector
BITS = 31
SEED = 20_011


@lru_cache(maxsize=8)
def _projections(width: int, passes: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).standard_normal((width, passes * BITS))


def unit(flat: np.ndarray, width: int) -> np.ndarray:
    """Rows of length one in double precision, also for very large or small components."""
    m = flat.astype(np.float64).reshape(-1, width)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _hashes(classes: DataFrame, passes: int) -> DataFrame:
    """Append ``keys``: for every pass the signs of the projections, first bit highest."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vec = b.column("v")
            lens = pc.list_value_length(vec).to_numpy()
            starts, flat = np.cumsum(lens) - lens, vec.flatten().to_numpy(zero_copy_only=False)
            keys = np.zeros((b.num_rows, passes), np.int32)
            for width in np.unique(lens).tolist():
                at = np.flatnonzero(lens == width)
                m = unit(flat[starts[at][:, None] + np.arange(width)].ravel(), width)
                signs = (m @ _projections(width, passes) >= 0).reshape(len(at), passes, BITS)
                keys[at] = signs @ weights
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, passes, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "keys"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, fields + ", keys array<int>")


def _matrix(rows: pa.Table) -> np.ndarray:
    width = int(pc.list_value_length(rows["v"][:1])[0].as_py())
    return unit(rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False), width)


def _neighbours(rows: pa.Table, threshold: float, window: int) -> list[np.ndarray] | None:
    """Spanning links of one block, whose rows come by position; pairs of rows from before the block are not its own."""
    ids, m = rows["cid"].to_numpy(), _matrix(rows)
    before = rows["before"].to_numpy(zero_copy_only=False)
    forest, links = _Forest(len(ids)), []
    for a in range(0, len(ids), 128):
        near = m[a:a + 128] @ m[a:a + 128 + window].T >= threshold
        left, right = np.nonzero(near)
        keep = (right > left) & (right - left <= window) & ~before[a + right]
        links.extend((i, j) for i, j in zip((a + left[keep]).tolist(), (a + right[keep]).tolist()) if forest.join(i, j))
    if not links:
        return None
    pairs = np.array(links, np.int64)
    return [ids[pairs[:, 0]], ids[pairs[:, 1]]]


def _counts(rows: pa.Table, threshold: float) -> list[np.ndarray] | None:
    """Links of each class inside one cell of a component: a part with itself, or two parts with each other."""
    ids, copies, part, m = rows["cid"].to_numpy(), rows["n"].to_numpy(), rows["part"].to_numpy(), _matrix(rows)
    first, second = int(part[0]), int(part[-1])
    own, other = np.flatnonzero(part == first), np.flatnonzero(part == second)
    more = np.zeros(len(ids), np.int64)
    for a in range(0, len(own), 512):
        at = own[a:a + 512]
        close = m[at] @ m[other].T >= threshold
        if first == second:
            close[np.arange(len(at)), a + np.arange(len(at))] = False
            more[at] += close @ copies[other]
        else:
            more[at] += close @ copies[other]
            more[other] += copies[at] @ close
    linked = np.flatnonzero(more)
    return [ids[linked], more[linked]] if len(linked) else None


def _by_group(rows: DataFrame, key: list[str], order: list[str], made: Callable, schema: str) -> DataFrame:
    """``made`` applied to the rows of each group of ``key``, in ``order``; a group is bounded by its caller."""
    names = [f.split()[0] for f in schema.split(", ")]
    dealt = rows.repartition(positive_partitions(rows.sparkSession), *key).sortWithinPartitions(*key, *order)

    def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = made(pa.Table.from_batches(held)) if held else None
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            codes = np.column_stack([b.column(c).dictionary_encode().indices.to_numpy() for c in key])
            cuts = np.concatenate(([0], np.flatnonzero((codes[1:] != codes[:-1]).any(axis=1)) + 1, [b.num_rows]))
            for x, z in zip(cuts.tolist(), cuts[1:].tolist()):
                if z == x:
                    continue
                if held and any(held[0].column(c)[0] != b.column(c)[x] for c in key):
                    yield from close(held)
                    held = []
                held.append(b.slice(x, z - x))
        yield from close(held)

    return dealt.mapInArrow(run, schema)


def _window_links(hashed: DataFrame, threshold: float, passes: int, window: int, block: int) -> DataFrame:
    """``a, b``: links that span what the windows of all passes see."""
    turned = F.array(*[F.concat(F.slice("keys", t + 1, passes - t), F.slice("keys", 1, t)) if t else F.col("keys") for t in range(passes)])
    narrow = hashed.select("cid", "label", F.size("v").alias("width"), F.posexplode(turned).alias("pass", "order"))
    key = ["pass", "label", "width"]
    ranked = prefix_rank(narrow, key, ["order", "cid"], out="pos").select(*key, "cid", "pos", F.expr(f"pos div {block}").alias("own"))
    # the last rows of a block are looked back at from the next one
    dealt = ranked.withColumn("block", F.explode(F.when(F.col("pos") % block >= block - window, F.array("own", F.col("own") + 1))
                                                 .otherwise(F.array("own"))))
    rows = dealt.join(hashed.select("cid", "v"), "cid").withColumn("before", F.col("block") > F.col("own"))
    return _by_group(rows.select(*key, "block", "pos", "before", "cid", "v"), [*key, "block"], ["pos"],
                     lambda t: _neighbours(t, threshold, window), "a long, b long")


def _component_links(members: DataFrame, threshold: float, part: int) -> DataFrame:
    """``cid, links``: for each class of ``members(cid, component, n, v)`` the other classes' rows that it links with."""
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    cut = members.withColumn("salt", F.pmod(F.xxhash64("cid", F.lit(5)), F.lit(SALT)).cast("int")).join(sizes, ["component", "salt"])
    cut = cut.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    cells = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "component", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "part", "cid", "n", "v")
    found = _by_group(cells, ["component", "low", "high"], ["part", "cid"], lambda t: _counts(t, threshold), "cid long, links long")
    return found.groupBy("cid").agg(F.sum("links").alias("links"))


def near_duplicates(df: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label", passes: int = PASSES, window: int = WINDOW, block: int = BLOCK, part: int = PART) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors meet only under equal, non-null labels and equal length. A null or zero
    vector, or one with null or non-finite components, links with nothing: zero
    links, a component of its own. Repeated rows and ids count each. No rows give no rows.
    ``window`` must not be larger than ``block``.
    """
    source = df.select(df[vec_id].cast("long").alias("vec_id"), df[vector].cast("array<double>").alias("v"),
                       df[label].cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("v").isNotNull()
              & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    good = source.where(usable)
    narrow = F.col("v").cast("array<float>")
    good = good.withColumn("v", narrow) if "float" in df.schema[vector].dataType.simpleString() else good
    # a class of equal vectors of one label is known by 128 bits of them
    good = good.withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64(F.lit(1), "label", "v"))
    classes = (good.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"),
                                            F.first("v").alias("v")).withColumn("cid", F.monotonically_increasing_id()))
    hashed, _ = materialise(_hashes(classes, passes), "projections")

    links, _ = materialise(_window_links(hashed, threshold, passes, window, block), "vector-links")
    parts, _ = materialise(connected_components(links, "a", "b").select(F.col("node").alias("cid"), "component"), "vector-components")
    members = parts.join(hashed.select("cid", "rep", "n", "v"), "cid")
    counts = _component_links(members.drop("rep"), threshold, part)
    low = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    summary = (hashed.select("cid", "h1", "h2", "rep", "n").join(parts, "cid", "left").join(low, "component", "left").join(counts, "cid", "left")
               .select("h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                       F.coalesce("component_id", "rep").alias("component_id"))
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    rows = good.select("vec_id", "h1", "h2", F.pmod(F.xxhash64("vec_id"), F.lit(SALT)).cast("int").alias("salt"))
    linked = rows.join(summary, ["h1", "h2", "salt"]).select("vec_id", "n_links", "component_id")
    alone = source.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
