"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The words of a shard of the corpus are laid out as one array of token ids
with neighbour links. An inverted index maps each adjacent pair that forms a
token to the positions where it stands. Merges are replayed in rank order:
each step takes one rank, merges all its positions at once, and only the
touched neighbours get new index entries.

Ranks are those of a public ``.tiktoken`` file; the result is what encoding
each match of the split pattern on its own gives. Null text counts as empty.
Shards are bounded: a task replays the distinct new words of a few megabytes
of text at a time and keeps a bounded table of words already done.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches, spans_gather

# Unicode White_Space, as the split pattern's \s reads it (fixed value).
WHITE = r"\t-\r \x85\xa0  -     　"
# A run of non-white characters with at most one space before it, or white space
# between such runs: no match of the split pattern crosses these units.
UNITS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
UNITS_KEPT = 400_000  # words a task remembers between batches
BATCH_BYTES = 8 << 20


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Token bytes by id, and all pairs of tokens whose concatenation is a token."""

    def __init__(self, raw: bytes):
        self.rank = {base64.b64decode(t): int(i) for t, i in (line.split() for line in raw.splitlines() if line)}
        size = max(self.rank.values()) + 1
        tokens = [b""] * size
        for t, i in self.rank.items():
            tokens[i] = t
        self.bytes_of = np.frombuffer(b"".join(tokens), np.uint8)
        self.lens = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.cumsum(self.lens) - self.lens
        self.byte_ids = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        found = [(self.rank[t[:k]] << 32 | self.rank[t[k:]], i) for t, i in self.rank.items()
                 for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank]
        found.sort()
        self.keys = np.array([k for k, _ in found] or [-1], np.int64)
        self.ids = np.array([i for _, i in found] or [-1], np.int32)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the token that a pair merges to, or -1."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ids[at], -1).astype(np.int32)


@lru_cache(maxsize=4)
def vocabulary(raw: bytes) -> Vocabulary:
    return Vocabulary(raw)


def merge_word(word: bytes, vocab: Vocabulary) -> list[int]:
    """One word on its own: again and again the leftmost pair of lowest rank."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        best = min((vocab.rank.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if best[0] == 1 << 40:
            break
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [vocab.rank[p] for p in parts]


def _without_overlap(pos: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of sorted positions, those left when each merge consumes its right neighbour."""
    touching = nxt[pos[:-1]] == pos[1:]
    if not touching.any():
        return pos
    keep = np.ones(len(pos), bool)
    for i in np.flatnonzero(touching):
        if keep[i]:
            keep[i + 1] = False
    return pos[keep]


def replay(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, concatenated, and the number of ids of each word."""
    whole = [vocab.rank.get(w, -1) for w in words]
    todo = [w if r < 0 else b"" for w, r in zip(words, whole)]
    lens = np.fromiter(map(len, todo), np.int64, len(todo))
    n = int(lens.sum())
    sym = vocab.byte_ids[np.frombuffer(b"".join(todo), np.uint8)] if n else np.zeros(0, np.int32)
    word = np.repeat(np.arange(len(todo), dtype=np.int32), lens)
    nxt = np.arange(1, n + 1, dtype=np.int32)
    prv = np.arange(-1, n - 1, dtype=np.int32)
    ends = np.cumsum(lens)[lens > 0]
    nxt[ends - 1] = -1
    prv[ends[:-1]] = -1
    rank = np.full(n, -1, np.int32)
    inner = np.flatnonzero(nxt >= 0)
    rank[inner] = vocab.pair_rank(sym[inner], sym[nxt[inner]])
    alive = np.ones(n, bool)

    # The inverted index: rank of a pair -> positions of its left token.
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(pos: np.ndarray) -> None:
        r = rank[pos]
        order = np.argsort(r, kind="stable")
        pos, r = pos[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for part, one in zip(np.split(pos, cuts), r[np.concatenate(([0], cuts))].tolist()):
            if one in index:
                index[one].append(part)
            else:
                index[one] = [part]
                heapq.heappush(queue, one)

    first = np.flatnonzero(rank >= 0)
    if len(first):
        enter(first)
    redo: set[int] = set()
    while queue:
        r = heapq.heappop(queue)
        parts = index.pop(r)
        pos = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
        pos = pos[rank[pos] == r]
        if not len(pos):
            continue
        pos = _without_overlap(pos, nxt)
        right = nxt[pos]
        after = nxt[right]
        sym[pos] = r
        nxt[pos] = after
        prv[after[after >= 0]] = pos[after >= 0]
        alive[right] = False
        rank[right] = -1
        before = prv[pos]
        touched = np.unique(np.concatenate((pos, before[before >= 0])))
        rank[touched] = -1
        linked = touched[nxt[touched] >= 0]
        fresh = vocab.pair_rank(sym[linked], sym[nxt[linked]])
        rank[linked] = fresh
        good = fresh >= 0
        linked, fresh = linked[good], fresh[good]
        if not len(linked):
            continue
        early = fresh < r
        if early.any():
            # A pair of lower rank came up. It goes first, which is exact unless the
            # same word had several positions in this step: such words are done alone.
            many, times = np.unique(word[pos], return_counts=True)
            redo.update(np.intersect1d(word[linked[early]], many[times > 1]).tolist())
        enter(linked)
    ids = sym[alive]
    counts = np.bincount(word[alive], minlength=len(words)) if n else np.zeros(len(words), np.int64)
    # Words that are one token, and words done alone, replace what the arrays hold.
    other = {i: [r] for i, r in enumerate(whole) if r >= 0} | {i: merge_word(words[i], vocab) for i in redo}
    if other:
        at = np.fromiter(sorted(other), np.int64, len(other))
        extra = [other[i] for i in at.tolist()]
        pool = np.concatenate((ids, np.array([x for e in extra for x in e], np.int32)))
        starts = np.cumsum(counts) - counts
        extra_lens = np.fromiter(map(len, extra), np.int64, len(extra))
        starts[at] = len(ids) + np.cumsum(extra_lens) - extra_lens
        counts = counts.copy()
        counts[at] = extra_lens
        ids = pool[spans_gather(starts, counts)]
    return ids, counts


class Encoder:
    """Encodes texts; remembers a bounded number of units between calls."""

    class _Numbers(dict):
        def __missing__(self, key):
            n = self[key] = len(self)
            return n

    def __init__(self, raw: bytes, pattern: str):
        self.vocab, self.split = vocabulary(raw), regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.number = self._Numbers()
        self.flat, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Replay the merges over the words of the units that are new."""
        new = list(self.number)[len(self.lens):] if len(self.number) > len(self.lens) else []
        if not new:
            return
        words: dict[str, int] = self._Numbers()
        per_unit, of = [], []
        for u in new:
            found = self.split.findall(u)
            per_unit.append(len(found))
            of.extend(map(words.__getitem__, found))
        ids, counts = replay([w.encode("utf-8", "surrogatepass") for w in words], self.vocab)
        starts = np.cumsum(counts) - counts
        of = np.array(of, np.int64)
        flat = ids[spans_gather(starts[of], counts[of])]
        bounds = np.concatenate(([0], np.cumsum(per_unit)))
        running = np.concatenate(([0], np.cumsum(counts[of])))
        self.flat = np.concatenate((self.flat, flat))
        self.lens = np.concatenate((self.lens, np.diff(running[bounds])))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and offsets by text."""
        if len(self.number) > UNITS_KEPT:
            self._forget()
        rows = [np.fromiter(map(self.number.__getitem__, UNITS.findall(t)), np.int32) if t else np.zeros(0, np.int32)
                for t in texts]
        self._learn()
        units = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        starts = np.cumsum(self.lens) - self.lens
        ids = self.flat[spans_gather(starts[units], self.lens[units])]
        running = np.concatenate(([0], np.cumsum(self.lens[units])))
        bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int64)
        return ids, running[bounds]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
           out: str = "ids") -> DataFrame:
    """Append ``out`` (array of token ids) to the ``keep`` columns of ``df``.

    Null and empty texts give an empty array; every row is kept, repeated rows
    included; other columns, whatever their names, are neither read nor shipped.
    The vocabulary file has a fixed size and is broadcast.
    """
    keep = keep if keep is not None else ["doc_id"]
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    source = df.select(*keep, df[text].cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(raw.value, pattern)
        for big in batches:
            for b in small_batches(big, "_text", BATCH_BYTES):
                ids, off = coder.encode(b.column("_text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [lists], names=[*keep, out])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append ``out`` (the bytes that the token ids stand for); a null array gives empty bytes."""
    raw = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType(), False)])
    names = [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(raw.value)
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                col = b.column(ids).fill_null([]) if b.column(ids).null_count else b.column(ids)
                tokens = col.flatten().to_numpy(zero_copy_only=False)
                per_row = np.asarray(pc.list_value_length(col), np.int64)
                size = v.lens[tokens]
                data = v.bytes_of[spans_gather(v.starts[tokens], size)]
                running = np.concatenate(([0], np.cumsum(size)))
                off = running[np.concatenate(([0], np.cumsum(per_row)))]
                bins = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(off.astype(np.int64)),
                                                                            pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays([*b.columns, bins.cast(pa.binary())], names=names)

    return df.mapInArrow(run, schema)
