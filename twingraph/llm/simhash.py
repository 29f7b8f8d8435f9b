"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint bit is the majority of that bit over the hashes of the word
shingles. Fingerprints within ``radius`` bits link. Two such fingerprints agree on
at least ``BLOCKS - radius`` of ``BLOCKS`` bit blocks, so each distinct
fingerprint is entered under every choice of that many blocks, and only
fingerprints under one key are compared.

The comparison is bit-sliced: the fingerprints of a block of rows, sorted by key,
lie as 64 vertical bit planes. For one shift the planes are compared with
themselves shifted, carry-save counters add up the differing bits of all rows at
once, and the block is left as soon as every row has more than ``radius``.
Keys with many fingerprints are cut into chunks, and every pair of chunks is a
task's block of its own, so no key is gathered whole and none is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, positive_partitions, small_batches
from .components import connected_components

BITS = 64
BLOCKS = 6
CHUNK = 2048  # fingerprints of one key that are compared in one block
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text; words are runs without ASCII white space, A-Z in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in
                       zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at:at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` holds the 64 bits in a signed long."""
    schema = T.StructType([T.StructField("doc_id", df.schema[doc_id].dataType), T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in small_batches(big, "_text"):
                fps = np.array([fingerprint(t, shingle) for t in b.column("_text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return (df.select(df[doc_id].alias("doc_id"), df[text].cast("string").alias("_text")).mapInArrow(run, schema))


def _blocks() -> list[tuple[int, int]]:
    """(first bit, width) of each block."""
    cuts = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def block_keys(fp, radius: int):
    """Array of keys: the bits of every choice of ``BLOCKS - radius`` blocks, hashed with the choice."""
    parts = [F.shiftrightunsigned(fp, a).bitwiseAND((1 << w) - 1) for a, w in _blocks()]
    return F.array(*[F.xxhash64(F.lit(n), *[parts[i] for i in chosen])
                     for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius))])


def _planes(values: np.ndarray) -> list[int]:
    """Bit k of all values as one long integer, row r at bit r."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return [int.from_bytes(np.packbits(bits[:, k], bitorder="little").tobytes(), "little") for k in range(bits.shape[1])]


def close_pairs(values: np.ndarray, groups: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, i + shift) of rows of one group within ``radius`` bits; rows are sorted by group.

    For each shift, ``low`` and ``high`` are the two bits of a saturating counter of
    every row (radius 3 needs 0..3, and ``over`` for more).
    """
    n = len(values)
    planes = _planes(values)
    sizes = np.diff(np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1], [True]))))
    for shift in range(1, int(sizes.max(initial=1))):
        same = np.packbits(groups[:-shift] == groups[shift:], bitorder="little")
        live = int.from_bytes(same.tobytes(), "little")
        if not live:
            break
        counter = [0] * (radius.bit_length())
        for plane in planes:
            carry = (plane ^ (plane >> shift)) & live
            for k in range(len(counter)):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            if carry:
                live &= ~carry
            if radius & (radius + 1):  # the counter can also hold values above the radius
                live &= ~_above(counter, radius)
            if not live:
                break
        if live:
            raw = np.frombuffer(live.to_bytes((n + 7) // 8, "little"), np.uint8)
            at = np.flatnonzero(np.unpackbits(raw, bitorder="little")[:n])
            yield at, at + shift


def _above(counter: list[int], radius: int) -> int:
    """Rows whose counter is larger than ``radius``."""
    above, equal = 0, -1
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


class _Forest:
    """Union-find over the rows of a block; ``join`` says whether the pair was news."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def block_links(values: np.ndarray, groups: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect all close rows of a block: a spanning forest, not all pairs."""
    forest, out = _Forest(len(values)), []
    for left, right in close_pairs(values, groups, radius):
        out.extend((i, j) for i, j in zip(left.tolist(), right.tolist()) if forest.join(i, j))
    return out


def fingerprint_links(distinct: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """``(a, b)`` links that connect all fingerprints within ``radius`` bits (column ``fp``)."""
    n = positive_partitions(distinct.sparkSession)
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), radius)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / chunk)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    cells = (keyed.join(shared, "key").withColumn("c", chunks).withColumn("k", mine)
             # every pair (i, j) of chunks that holds this row's chunk
             .select("fp", "key", F.explode(F.transform(
                 F.sequence(F.lit(0), F.col("c") - 1),
                 lambda o: F.least(o, F.col("k")).cast("long") * F.col("c") + F.greatest(o, F.col("k")))).alias("cell"))
             .repartition(n, "key", "cell").sortWithinPartitions("key", "cell", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            rows = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cell", "fp")])
            rest = rows if rest is None else np.concatenate((rest, rows))
            if len(rest) >= 2 * chunk:
                new = np.flatnonzero((rest[1:, :2] != rest[:-1, :2]).any(axis=1))
                if len(new):
                    yield links_of(rest[:new[-1] + 1])
                    rest = rest[new[-1] + 1:]
        if rest is not None and len(rest):
            yield links_of(rest)

    def links_of(rows: np.ndarray) -> pa.RecordBatch:
        change = np.concatenate(([0], (rows[1:, :2] != rows[:-1, :2]).any(axis=1).astype(np.int64)))
        groups, out = np.cumsum(change), []
        at = 0
        while at < len(rows):  # blocks of whole groups
            to = min(at + 2 * chunk, len(rows))
            if to < len(rows):
                first = int(np.searchsorted(groups, groups[to], side="left"))
                to = first if first > at else int(np.searchsorted(groups, groups[to], side="right"))
            fp = rows[at:to, 2]
            out.extend((int(fp[i]), int(fp[j])) for i, j in block_links(fp.view(np.uint64), groups[at:to], radius))
            at = to
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))],
                                          names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row: the smallest id reachable over links of up to ``radius`` bits.

    Null, empty and white texts have fingerprint 0 and link like any other; fewer
    words than ``shingle`` form one shingle. Repeated rows each come out. A null id
    is kept and never names a component unless all ids of the component are null.
    An empty table gives an empty table.
    """
    fps, _ = materialise(fingerprints(df, doc_id, text, shingle), "fingerprints")
    reps, _ = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-reps")
    parts = connected_components(fingerprint_links(reps.select("fp"), radius), "a", "b")
    # smallest document of each component of fingerprints
    member = reps.join(parts, reps.fp == parts.node, "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component"))
    low = member.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = member.join(low, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")
