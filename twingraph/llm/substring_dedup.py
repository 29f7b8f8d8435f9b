"""Substring dedup with compressed FM-indexes per shard.

A window of ``window`` words that also starts elsewhere is repeated; every word under
a repeated window goes. Equal windows have equal smallest k-gram hashes (anchors), so
a document is cut into runs of windows with one anchor, and only runs whose anchor
occurs again are looked at: their words go to the shard of the anchor. A shard
builds an FM-index (suffix order, transform in a wavelet matrix of packed bits with
block counts) over the different runs it holds. Then the runs are streamed against it:
backward search gives the longest matches with a second occurrence, and the stretches
of at least ``window`` words are reported.

The words of equal runs are kept once, by a hash of 128 bits, with how often they occur;
what each occurrence must know travels as numbers. An anchor with more runs than one
index holds is dealt by further anchors of the same windows (smallest hashes of the
k-grams under other functions), so its runs become shorter and go to different shards;
they are searched there like all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_path, materialise, positive_partitions, small_batches, spans_gather, utf8, with_text

WINDOW = 35
GRAM = 5             # words of the k-gram that anchors a window
RUN = 32             # windows of a run at most (bits of its mask)
SHARD_WORDS = 400_000  # words of one index
FURTHER = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # what makes further anchors differ
SEEN = 200_000       # run texts that a task remembers having sent
SALT = 8             # shares of one anchor or run text in the joins of narrow rows

_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    if n:
        out[1:] = base
    return np.cumprod(out, dtype=np.uint64)


class _Hasher:
    """64-bit content hashes of words, from running sums of bytes times powers."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def words(self, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            self.up, self.down = _powers(_P, len(data) + 1024), _powers(_P_INVERSE, len(data) + 1024)
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], dtype=np.uint64)))
        return mixed((run[end] - run[first]) * self.down[first])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end) of all words: runs without ASCII white space inside a row."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    row_start = np.zeros(len(data) + 1, bool)
    row_start[off] = True
    first = ~space
    first[1:] &= space[:-1] | row_start[1:-1]
    last = ~space
    last[:-1] &= space[1:] | row_start[1:-1]
    a, z = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(off, a, side="right") - 1, a, z


def _sliding(values: np.ndarray, need: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``need`` neighbours, by doubling."""
    out, span = values, 1
    while span * 2 <= need:
        out, span = pick(out[:-span], out[span:]), span * 2
    return pick(out[:len(out) - (need - span)], out[need - span:]) if span < need else out


def gram_hashes(hashes: np.ndarray, gram: int) -> np.ndarray:
    grams = np.zeros(len(hashes) - gram + 1, np.uint64)
    factor = np.uint64(1)
    for k in range(gram):
        grams += hashes[k:len(grams) + k] * factor
        factor = np.uint64((int(factor) * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF)
    return mixed(grams)


def further_runs(grams: np.ndarray, first: int, count: int, need: int) -> Iterator[tuple[int, int, int]]:
    """(first window, windows, key) of the stretches of a run whose further anchors are the same."""
    lows = [_sliding(mixed(grams[first:first + count + need - 1] ^ np.uint64(f)), need, np.minimum) for f in FURTHER]
    change = np.ones(count, bool)
    change[1:] = np.any([low[1:] != low[:-1] for low in lows], axis=0)
    start = np.flatnonzero(change)
    key = lows[0].copy()
    for low in lows[1:]:
        key = mixed(key ^ low)
    for s, z in zip(start.tolist(), [*start[1:].tolist(), count]):
        yield first + s, z - s, int(key[s:s + 1].view(np.int64)[0])


def anchored_runs(row: np.ndarray, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, anchor, places of the anchor) of the runs; windows are numbered by their first word."""
    n = len(hashes) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grams, need = gram_hashes(hashes, gram), window - gram + 1
    low = _sliding(grams, need, np.minimum)
    inside = row[:n] == row[window - 1:]
    change = np.ones(n, bool)
    change[1:] = (low[1:] != low[:-1]) | (row[1:n] != row[:n - 1]) | (inside[1:] != inside[:-1])
    start = np.flatnonzero(change)
    size = np.diff(np.append(start, n))
    start, size = start[inside[start]], size[inside[start]]
    parts = -(-size // RUN)  # long runs are cut; where does not matter
    whole = np.repeat(np.arange(len(start)), parts)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = start[whole] + nth * RUN
    count, anchor = np.minimum(size[whole] - nth * RUN, RUN), low[first]
    # A text that goes round in a circle repeats windows inside one run: the anchor stands there more than once.
    edge = np.zeros(need - 1, np.uint64)
    places = np.flatnonzero(_sliding(np.concatenate((edge, low, edge)), need, np.maximum) == grams)
    a, z = np.searchsorted(places, first), np.searchsorted(places, first + count + need - 1)
    of = np.repeat(np.arange(len(first)), z - a)
    times = np.bincount(of[grams[places[spans_gather(a, z - a)]] == anchor[of]], minlength=len(first))
    return first, count, anchor.view(np.int64), times


class FMIndex:
    """FM-index over word numbers (1 and up); the pieces are separated by number 0."""

    def __init__(self, text: np.ndarray, separators: np.ndarray):
        n = len(text)
        order = self._suffix_order(text, separators)
        turned = text[order - 1]
        symbols = int(text.max(initial=0)) + 1
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        self.levels = []
        column = turned.copy()
        for level in reversed(range(max(1, symbols.bit_length()))):
            bit = (column >> level) & 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            bits = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed[:len(bits)] = bits
            words = packed.view("<u8")
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1].astype(np.int32)
            zeros = n - int(bit.sum())
            self.levels.append((level, words, counts, zeros))
            column = np.concatenate((column[bit == 0], column[bit == 1]))
        # where the rows of a symbol begin in the last column
        change = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
        self.bottom = np.zeros(symbols, np.int64)
        self.bottom[column[change]] = change

    @staticmethod
    def _suffix_order(text: np.ndarray, separators: np.ndarray) -> np.ndarray:
        """Suffixes sorted by prefix doubling; every separator is smaller than words and unlike the others."""
        n = len(text)
        rank = text.astype(np.int64) + len(separators)
        rank[separators] = np.arange(len(separators))
        order = np.argsort(rank, kind="stable")
        _, rank = np.unique(rank, return_inverse=True)
        # a rank is the position at which its group begins
        begin = np.searchsorted(rank[order], np.arange(rank.max() + 1))
        rank = begin[rank]
        span = 1
        while True:
            sorted_rank = rank[order]
            new = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
            size = np.diff(np.append(np.flatnonzero(new), n))
            tied = np.flatnonzero(np.repeat(size > 1, size))
            if not len(tied):
                return order
            who = order[tied]
            nxt = np.where(who + span < n, rank[np.minimum(who + span, n - 1)], -1)
            key = rank[who] * (n + 1) + nxt + 1
            by = np.argsort(key, kind="stable")
            order[tied] = who[by]
            key = key[by]
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            # new rank: the position in the whole order of the first suffix of its group
            rank = rank.copy()
            rank[who[by]] = tied[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            span *= 2

    def back(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffix rows after one more word to the left."""
        at, twice = np.concatenate((low, high)), np.concatenate((symbol, symbol))
        for level, words, counts, zeros in self.levels:
            block = at >> 6
            below = words[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = counts[block] + np.bitwise_count(below).astype(np.int64)
            at = np.where((twice >> level) & 1 == 1, zeros + ones, at - ones)
        at += (self.starts - np.append(self.bottom, 0))[twice]
        return at[:len(low)], at[len(low):]

    def longest(self, text: np.ndarray, end: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Words before ``end``, at most ``limit``, that form a string with two occurrences or more."""
        done = np.zeros(len(end), np.int64)
        live = np.arange(len(end))
        symbol = text[end - 1]
        low, high = self.starts[symbol], self.starts[symbol + 1]
        while True:
            good = high - low >= 2
            live, low, high = live[good], low[good], high[good]
            done[live] += 1
            more = done[live] < limit[live]
            live, low, high = live[more], low[more], high[more]
            if not len(live):
                return done
            low, high = self.back(low, high, text[end[live] - 1 - done[live]])


def repeated_windows(pieces: list[list[int]], windows: np.ndarray, weights: np.ndarray, window: int) -> np.ndarray:
    """Mask of the repeated windows of each piece; pieces differ, ``weights`` says how often each occurs."""
    lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = np.cumsum(lens + 1) - lens - 1
    text = np.zeros(int((lens + 1).sum()), np.int64)
    keep = np.ones(len(text), bool)
    keep[begin + lens] = False
    text[keep] = np.fromiter((w for p in pieces for w in p), np.int64, int(lens.sum()))
    masks = np.where(weights > 1, (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1), np.uint64(0))
    todo = np.flatnonzero(weights == 1)
    if not len(todo):
        return masks
    index = FMIndex(text, begin + lens)
    left, right = np.zeros(len(pieces), np.int64), windows - 1

    def mark(who: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        ones = (np.uint64(1) << (b - a + 1).astype(np.uint64)) - np.uint64(1)
        masks[who] |= ones << a.astype(np.uint64)

    while len(todo):
        # The leftmost open window: if it is not repeated, no window over the unmatched word is.
        end = begin[todo] + left[todo] + window
        got = index.longest(text, end, np.full(len(todo), window, np.int64))
        whole = got >= window
        mark(todo[whole], left[todo[whole]], left[todo[whole]])
        left[todo] = np.where(whole, left[todo] + 1, left[todo] + window - got)
        # Where it is, match back from the end of the rightmost open window as far as it goes.
        far = todo[whole & (left[todo] <= right[todo])]
        if len(far):
            end = begin[far] + right[far] + window
            got = index.longest(text, end, right[far] + window - left[far])
            good = got >= window
            first = right[far] + window - got
            mark(far[good], first[good], right[far][good])
            right[far] = np.where(good, first - 1, right[far] - 1)
        todo = todo[left[todo] <= right[todo]]
    return masks


def _runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, th, start, n, anchor, times`` of every run of every document; ``times`` is 2 for more."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("th", T.LongType()), T.StructField("start", T.IntegerType()),
                           T.StructField("n", T.ByteType()), T.StructField("anchor", T.LongType()),
                           T.StructField("times", T.ByteType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for big in batches:
            for b in small_batches(big, "text", 2 << 20):
                data, off = utf8(b.column("text"))
                row, a, z = words_of(data, off)
                first, n, anchor, times = anchored_runs(row, hasher.words(data, a, z), window, gram)
                begin = np.searchsorted(row, np.arange(b.num_rows))
                of = row[first]
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("th").take(take), pa.array((first - begin[of]).astype(np.int32)),
                     pa.array(n.astype(np.int8)), pa.array(anchor), pa.array(np.minimum(times, 2).astype(np.int8))], names=schema.names)

    return docs.mapInArrow(run, schema)


def _pieces(docs: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """The wanted runs: ``doc_id, th, starts, n, shard, id1, id2, weight, piece``; runs of split anchors as shorter ones.

    ``id1`` and ``id2`` name the words; the words themselves stand in the first row of a task that has them.
    What a document holds several times (a text that goes round in a circle) is one row with all its starts.
    """
    keyed = docs.join(wanted, [docs.doc_id.eqNullSafe(wanted.doc_id), docs.th == wanted.th]).select(
        docs.doc_id, docs.th, "text", "runs")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("th", T.LongType()), T.StructField("starts", T.ArrayType(T.IntegerType())),
                           T.StructField("n", T.ByteType()), T.StructField("shard", T.LongType()), T.StructField("id1", T.LongType()),
                           T.StructField("id2", T.LongType()), T.StructField("weight", T.LongType()), T.StructField("piece", T.BinaryType())])
    need = window - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        hasher = _Hasher()
        for big in batches:
            for b in small_batches(big, "text", 1 << 20):
                rows = []
                for row, (text, runs) in enumerate(zip(b.column("text").to_pylist(), b.column("runs").to_pylist())):
                    raw = text.encode("utf-8", "surrogatepass")
                    words = raw.split()
                    if any(r["split"] for r in runs):
                        data = np.frombuffer(raw, np.uint8)
                        _, first, end = words_of(data, np.array([0, len(data)]))
                        grams = gram_hashes(hasher.words(data, first, end), gram)
                    own: dict[tuple, list[int]] = {}
                    for r in runs:
                        parts = further_runs(grams, r["start"], r["n"], need) if r["split"] else ((r["start"], r["n"], 0),)
                        for start, n, key in parts:
                            own.setdefault((r["anchor"] ^ key, n, b" ".join(words[start:start + window - 1 + n])), []).append(start)
                    for (shard, n, piece), starts in own.items():
                        name = hashlib.blake2b(piece, digest_size=16).digest()
                        fresh = name not in seen
                        if fresh:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(name)
                        rows.append((row, starts, n, shard, name, len(starts), piece if fresh else None))
                at, starts, n, shard, names, weight, piece = zip(*rows) if rows else ((),) * 7
                take = pa.array(at, pa.int64())
                ids = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("th").take(take), pa.array(starts, pa.list_(pa.int32())), pa.array(n, pa.int8()),
                     pa.array(shard, pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(weight, pa.int64()),
                     pa.array(piece, pa.binary())], names=schema.names)

    return keyed.mapInArrow(run, schema)


def _search(pieces: DataFrame, window: int, shard_words: int) -> DataFrame:
    """``id1, id2, mask`` of the different pieces with repeated windows, shard by shard.

    A shard's rows are the words of its pieces (several tasks may have sent the same) and, in other
    rows, how often each piece occurs.
    """
    n = positive_partitions(pieces.sparkSession)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("id1", "id2", "mask")])
    key = ["shard", "id1", "id2", "n"]
    words = pieces.where("piece is not null").select(*key, "piece", F.lit(0).cast("long").alias("weight"))
    counts = pieces.groupBy(*key).agg(F.sum("weight").alias("weight")).select(*key, F.lit(None).cast("binary").alias("piece"), "weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for b in batches:
            shard = b.column("shard").to_numpy()
            # A batch is cut at the shards' edges so that an index holds whole shards.
            edges = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]))
            n_words = np.cumsum((np.asarray(b.column("n").to_numpy(), np.int64) + window) * np.asarray(b.column("piece").is_valid()))
            at = 0
            for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if z == a:
                    continue
                before = size + int(n_words[a - 1] if a else 0) - int(n_words[at - 1] if at else 0)
                if before >= shard_words and shard[a] != last:
                    held.append(b.slice(at, a - at))
                    yield found(held)
                    held, size, at = [], 0, a
                last = shard[a]
            held.append(b.slice(at))
            size += int(n_words[-1] if len(n_words) else 0) - int(n_words[at - 1] if at else 0)
        if held:
            yield found(held)

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        ids = np.stack([t["id1"].to_numpy(), t["id2"].to_numpy()], axis=1)
        names, of = np.unique(ids, axis=0, return_inverse=True)
        of = of.ravel()
        weights, windows = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        np.add.at(weights, of, t["weight"].to_numpy())
        windows[of] = t["n"].to_numpy()
        word: dict[bytes, int] = {}
        numbered: list[list[int]] = [[] for _ in names]
        for i, p in zip(of.tolist(), t["piece"].to_pylist()):
            if p is not None and not numbered[i]:
                numbered[i] = [word.setdefault(w, len(word) + 1) for w in p.split(b" ")]
        masks = repeated_windows(numbered, windows, weights, window)
        hit = masks > 0
        return pa.RecordBatch.from_arrays([pa.array(names[hit, 0]), pa.array(names[hit, 1]), pa.array(masks[hit].view(np.int64))],
                                          names=schema.names)

    return words.unionByName(counts).repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def _salted_join(many: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which the rows of one key of ``many`` are dealt to ``SALT`` shares."""
    return (many.withColumn("_salt", F.pmod(F.xxhash64(*many.columns[:3]), F.lit(SALT)))
            .join(few.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))), [*on, "_salt"])
            .drop("_salt"))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
                   gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_removed`` and ``kept`` (words left, joined by one blank) of every row.

    Null, empty and short texts lose nothing; nothing is kept of a document whose words
    are all covered. Repeated rows repeat each other's windows. Windows are judged on
    the input. No rows give no rows. Texts are compared as bytes.
    """
    keep = keep if keep is not None else ["doc_id"]
    spark = df.sparkSession
    th = F.xxhash64(df[doc_id], df[text])
    docs = df.select(df[doc_id].alias("doc_id"), th.alias("th"), F.coalesce(df[text].cast("string"), F.lit("")).alias("text"))
    runs, runs_path = materialise(_runs(docs, window, gram), "runs")
    again = runs.groupBy("anchor").agg(F.sum("times").alias("c")).where("c > 1")
    again = again.select("anchor", (F.col("c") * window > shard_words).alias("split"))
    wanted = (_salted_join(runs.select("th", "start", "doc_id", "n", "anchor"), again, ["anchor"]).groupBy("doc_id", "th")
              .agg(F.collect_set(F.struct("start", "n", "anchor", "split")).alias("runs")))
    pieces, pieces_path = materialise(_pieces(docs, wanted, window, gram), "pieces")
    drop_path(spark, runs_path)
    known = _search(pieces, window, shard_words)
    found = _salted_join(pieces.select("th", "starts", "doc_id", "n", "id1", "id2"), known, ["id1", "id2"])
    spans = (found.select("doc_id", "th", F.transform("starts", lambda s: F.struct(s.alias("start"), F.col("n"), F.col("mask"))).alias("spans"))
             .groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    spans, _ = materialise(spans, "spans")
    drop_path(spark, pieces_path)
    return _cut(df, doc_id, text, th, spans, keep, window)


def _cut(df: DataFrame, doc_id: str, text: str, th, spans: DataFrame, keep: list[str], window: int) -> DataFrame:
    """Apply the reported windows to the texts."""
    _, column = with_text(df, keep, text)
    source = df.select(*keep, *([df[text].cast("string").alias(column)] if column not in keep else []), df[doc_id].alias("_id"), th.alias("_th"))
    joined = (source.join(spans, [source["_id"].eqNullSafe(spans["doc_id"]), source["_th"] == spans["th"]], "left")
              .select(*[source[c] for c in dict.fromkeys([*keep, column])], "spans"))
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_words", T.LongType(), False),
                           T.StructField("n_removed", T.LongType(), False), T.StructField("kept", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in small_batches(big, column, 2 << 20):
                total, removed, kept = [], [], []
                for t, found in zip(b.column(column).to_pylist(), b.column("spans").to_pylist()):
                    words = (t or "").encode("utf-8", "surrogatepass").split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    for s in found or ():
                        mask = s["mask"] & 0xFFFFFFFFFFFFFFFF
                        for k in range(s["n"]):
                            if mask >> k & 1:
                                gone[s["start"] + k] += 1
                                gone[s["start"] + k + window] -= 1
                    stays = np.cumsum(gone)[:-1] == 0
                    total.append(len(words))
                    removed.append(int(len(words) - stays.sum()))
                    kept.append(b" ".join([w for w, s in zip(words, stays.tolist()) if s] if found else words).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, pa.string())], names=schema.names)

    return joined.mapInArrow(run, schema)
