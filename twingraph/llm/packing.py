"""Best-fit packing of token pieces by a grouping genetic algorithm.

A document longer than a sequence is cut; whole sequences stand alone, and the
other pieces are packed. Pieces are dealt to problems of bounded size, and each
problem is searched by several islands. A chromosome is a list of bins. Crossover
injects well-filled bins of one parent whole into the other, removes the bins that
hold a piece twice, and best-fits the displaced pieces. After each epoch the
islands of a problem pass their best packing to the next island. Bins that are
almost full are then final; the pieces of the others go to the next round, where
they meet the rest of other problems.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import materialise, positive_partitions, small_batches, spans_gather

LENGTH = 2048
END_ID = 0
SPLITS_KEPT = 500_000  # splits that a worker remembers
BATCH_BYTES = 8 << 20

PROBLEM = 4096      # pieces of a problem, on average
ISLANDS = 2
EPOCHS = 2
ROUNDS = 3
POPULATION = 4
OFFSPRING = 4       # crossovers of an island in an epoch
FULL = 0.998        # fill of a bin that is final before the last round


# Words of these characters alone: none is white space, combines with a neighbour or has
# another lower case than its letter's own, so they are lower-cased and split in bulk.
PLAIN = r"^[!-~\x{00a1}-\x{012f}\x{0131}-\x{02af}\x{0400}-\x{0482}\x{048a}-\x{04ff}]+$"
# The file's own split pattern (fixed value).
SPLIT = r"('s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\s\pL\pN]+)"


def _byte_letters() -> dict[int, int]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others for 256 and up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(other) if b != 32}


class WordEncoder:
    """Token ids of texts by a ``tokenizers`` file that splits at white space.

    The distinct words of a batch are lower-cased and split by the file's pattern; the
    distinct splits go through the file's merges together, once while they are
    remembered. Words outside ``PLAIN`` go through the whole tokenizer one by one.
    """

    def __init__(self, raw: str):
        self.tok = Tokenizer.from_str(raw)
        self.tok.encode_special_tokens = True  # such strings in a text are ordinary text
        bare = json.loads(raw) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(bare))
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        """No split is known; the known ones' ids lie flat, in the order of ``known``."""
        self.known = pa.array([], pa.large_string())
        self.flat, self.lens = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _learn(self, splits: pa.Array) -> None:
        plain = np.asarray(pc.string_is_ascii(splits))
        splits = pa.concat_arrays([splits.filter(pa.array(plain)), splits.filter(pa.array(~plain))])
        ascii_part = splits.slice(0, int(plain.sum())).to_pylist()
        other = " ".join(splits.slice(len(ascii_part)).to_pylist()).encode().decode("latin-1").translate(self.letters)
        done = self.model.encode(" ".join([*ascii_part, other] if other else ascii_part), add_special_tokens=False)
        self.known = pa.concat_arrays([self.known, splits])
        self.flat = np.concatenate((self.flat, np.array(done.ids, np.uint32)))
        self.lens = np.concatenate((self.lens, np.bincount(np.array(done.word_ids, np.int64), minlength=len(splits))))

    def _numbers(self, splits: pa.Array) -> np.ndarray:
        """Places of the splits among the known ones; new ones are learned."""
        coded = splits.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.known)
        if at.null_count:
            self._learn(coded.dictionary.filter(at.is_null()))
            at = pc.index_in(coded.dictionary, value_set=self.known)
        return at.to_numpy(zero_copy_only=False).astype(np.int64)[coded.indices.to_numpy()]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, concatenated, and their number for each word."""
        plain = np.asarray(pc.match_substring_regex(words, PLAIN))
        lower = pc.utf8_lower(words.filter(pa.array(plain)))
        whole = np.asarray(pc.utf8_is_alpha(lower))  # one split
        parts = pc.ascii_split_whitespace(pc.utf8_rtrim_whitespace(
            pc.replace_substring_regex(lower.filter(pa.array(~whole)), SPLIT, r"\1 ")))
        splits = pa.concat_arrays([lower.filter(pa.array(whole)), parts.flatten()])
        number = self._numbers(splits)
        lens = self.lens[number]
        ids = self.flat[spans_gather((np.cumsum(self.lens) - self.lens)[number], lens)]
        n, running = int(whole.sum()), np.concatenate(([0], np.cumsum(lens)))
        ends = running[n + np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(parts), np.int64))))]
        size, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        one, some = np.flatnonzero(plain)[whole], np.flatnonzero(plain)[~whole]
        size[one], start[one] = lens[:n], running[:n]
        size[some], start[some] = np.diff(ends), ends[:-1]
        if not plain.all():
            alone = [self.tok.encode(w, add_special_tokens=False).ids for w in words.filter(pa.array(~plain)).to_pylist()]
            size[~plain] = [len(x) for x in alone]
            start[~plain] = len(ids) + np.cumsum(size[~plain]) - size[~plain]
            ids = np.concatenate((ids, np.array([x for a in alone for x in a], np.uint32)))
        return ids[spans_gather(start, size)], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and offsets by text; pre-tokens never cross ASCII white space."""
        if len(self.known) > SPLITS_KEPT:
            self._forget()
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = split.flatten().dictionary_encode()  # may hold an empty string, which has no ids
        ids, lens = self._words(coded.dictionary)
        at = coded.indices.to_numpy()
        out = ids[spans_gather((np.cumsum(lens) - lens)[at], lens[at])]
        per_text = np.asarray(pc.list_value_length(split), np.int64)
        return out, np.concatenate(([0], np.cumsum(lens[at])))[np.concatenate(([0], np.cumsum(per_text)))]


@lru_cache(maxsize=2)
def encoder(raw: str) -> WordEncoder:
    """One encoder for a Python worker, so that its tasks share the words that it remembers."""
    return WordEncoder(raw)


def pieces(df: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document; ``ids`` is little-endian uint32 binary.

    A document is its token ids and ``end_id``; null and empty texts have the end id
    alone. Only documents above ``length`` are cut. Repeated rows come out each.
    The tokenizer file has a fixed size and is broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([T.StructField("doc_id", df.schema[doc_id].dataType), T.StructField("piece", T.IntegerType(), False),
                           T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False),
                           T.StructField("ids", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(raw.value)
        for big in batches:
            for b in small_batches(big, "_text", BATCH_BYTES):
                at, piece, start, size, data = [], [], [], [], []
                flat, off = coder.encode(b.column("_text"))
                for row in range(b.num_rows):
                    ids = np.append(flat[off[row]:off[row + 1]], np.uint32(end_id)).astype("<u4")
                    for n, s in enumerate(range(0, len(ids), length)):
                        part = ids[s:s + length]
                        at.append(row), piece.append(n), start.append(s), size.append(len(part)), data.append(part.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(data, pa.binary())], names=schema.names)

    return df.select(df[doc_id].alias("doc_id"), df[text].cast("string").alias("_text")).mapInArrow(run, schema)


class Bins:
    """A packing: bin of each piece and the room left in each bin."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bin_of = np.full(len(sizes), -1, np.int64)
        self.room: list[int] = []

    def place(self, items: np.ndarray) -> Bins:
        """Best fit, largest first: each piece goes to the fullest bin that has room for it."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        for b, r in enumerate(self.room):
            by_room[r].append(b)
        some = sum(1 << r for r in range(self.capacity + 1) if by_room[r])  # bit r: a bin with room r
        sizes = self.sizes
        for i in items[np.argsort(-sizes[items], kind="stable")].tolist():
            s = int(sizes[i])
            fitting = some >> s
            if fitting:
                r = s + (fitting & -fitting).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    some &= ~(1 << r)
            else:
                r, b = self.capacity, len(self.room)
                self.room.append(r)
            r -= s
            self.room[b] = r
            by_room[r].append(b)
            some |= 1 << r
            self.bin_of[i] = b
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then uneven filling: full bins beside emptier ones leave more to gain."""
        fill = 1.0 - np.array(self.room) / self.capacity
        return -len(self.room), float((fill ** 2).sum())


def crossover(one: Bins, two: Bins, rng: np.random.Generator) -> Bins:
    """``two`` with some well-filled bins of ``one`` injected whole.

    Bins of ``two`` that hold an injected piece are taken apart; their other pieces
    are displaced and placed again, together with those of a few loose bins.
    """
    n1, n2 = len(one.room), len(two.room)
    room = np.array(one.room)
    good = np.argsort(room + rng.random(n1), kind="stable")[:max(1, n1 // 2)]
    chosen = np.zeros(n1, bool)
    chosen[rng.choice(good, max(1, len(good) // 2), replace=False)] = True
    injected = chosen[one.bin_of]
    broken = np.zeros(n2, bool)
    broken[two.bin_of[injected]] = True
    loose = np.argsort(-np.array(two.room), kind="stable")[:max(1, n2 // 20)]
    broken[loose] = True
    stays = ~injected & ~broken[two.bin_of]
    child = Bins(one.sizes, one.capacity)
    number1, number2 = np.cumsum(chosen) - 1, np.cumsum(~broken) - 1 + int(chosen.sum())
    child.bin_of[injected] = number1[one.bin_of[injected]]
    child.bin_of[stays] = number2[two.bin_of[stays]]
    child.room = room[chosen].tolist() + np.array(two.room)[~broken].tolist()
    return child.place(np.flatnonzero(child.bin_of < 0))


def first_population(sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> list[Bins]:
    """Best fit on all pieces, and packings that begin with random bins filled at random."""
    out = [Bins(sizes, capacity).place(np.arange(len(sizes)))]
    while len(out) < POPULATION:
        b = Bins(sizes, capacity)
        some = rng.permutation(len(sizes))[:len(sizes) // 4]
        filled = 0
        for i in some.tolist():
            if not b.room or b.room[-1] < sizes[i]:
                filled = len(b.room)
                b.room.append(capacity)
            b.room[filled] -= int(sizes[i])
            b.bin_of[i] = filled
        out.append(b.place(np.flatnonzero(b.bin_of < 0)))
    return out


def evolve(population: list[Bins], rng: np.random.Generator, offspring: int = OFFSPRING) -> list[Bins]:
    """Some generations: tournament parents, grouping crossover, the worst is replaced."""
    population = sorted(population, key=Bins.fitness, reverse=True)
    total, capacity = int(population[0].sizes.sum()), population[0].capacity
    for _ in range(offspring):
        if len(population[0].room) <= -(-total // capacity):
            break  # no packing has fewer bins
        i, j = sorted(rng.choice(len(population), 2, replace=False).tolist())
        child = crossover(population[i], population[j], rng)
        population = sorted([*population, child], key=Bins.fitness, reverse=True)[:POPULATION]
    return population


def _epoch(state: DataFrame, capacity: int, seed: int, first: bool) -> DataFrame:
    """One epoch of every island. A row is a problem's island with its sizes and packings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                rng = np.random.default_rng([seed, row["problem"], row["island"]])
                if first:
                    population = first_population(sizes, capacity, rng)
                else:
                    population = []
                    for bins in row["packings"]:
                        p = Bins(sizes, capacity)
                        p.bin_of = np.array(bins, np.int64)
                        p.room = (capacity - np.bincount(p.bin_of, sizes).astype(np.int64)).tolist()
                        population.append(p)
                population = evolve(population, rng)
                yield pa.RecordBatch.from_pylist(
                    [row | {"packings": [p.bin_of.tolist() for p in population]}],
                    schema=pa.schema([("problem", pa.int64()), ("island", pa.int32()), ("uids", pa.list_(pa.int64())),
                                      ("sizes", pa.list_(pa.int64())), ("packings", pa.list_(pa.list_(pa.int64())))]))

    return state.mapInArrow(run, "problem long, island int, uids array<long>, sizes array<long>, packings array<array<long>>")


def _migrate(state: DataFrame) -> DataFrame:
    """Each island's best packing replaces the worst of the next island of its problem."""
    elite = state.select("problem", ((F.col("island") + 1) % ISLANDS).alias("island"), F.get("packings", F.lit(0)).alias("elite"))
    return state.join(elite, ["problem", "island"]).select(
        "problem", "island", "uids", "sizes",
        F.concat(F.slice("packings", 1, POPULATION - 1), F.array("elite")).alias("packings"))


def _search(items: DataFrame, problems: int, capacity: int, round_no: int) -> DataFrame:
    """``uid, length, problem, bin`` of the best packing of each problem; ``items`` has ``uid, length``."""
    n = positive_partitions(items.sparkSession)
    where = F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(problems))
    state = (items.groupBy(where.alias("problem")).agg(F.sort_array(F.collect_list(F.struct("length", "uid"))).alias("all"))
             .select("problem", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
                     F.transform("all", lambda x: x["uid"]).alias("uids"), F.transform("all", lambda x: x["length"]).alias("sizes"),
                     F.lit(None).cast("array<array<long>>").alias("packings"))
             .repartition(n, "problem", "island"))
    for e in range(EPOCHS):
        if e:
            state = _migrate(state)
        state, _ = materialise(_epoch(state, capacity, 97 * round_no + e, first=not e), "islands")
    best = F.min_by("packing", F.struct("bins", "island"))
    packed = (state.withColumn("packing", F.get("packings", F.lit(0))).withColumn("bins", F.array_max("packing"))
              .groupBy("problem").agg(best.alias("packing"), F.first("uids").alias("uids"), F.first("sizes").alias("sizes")))
    return packed.select("problem", F.explode(F.arrays_zip("uids", "sizes", "packing")).alias("x")).select(
        F.col("x.uids").alias("uid"), F.col("x.sizes").alias("length"), "problem", F.col("x.packing").alias("bin"))


def pack(sizes: DataFrame, capacity: int = LENGTH, problem: int = PROBLEM, rounds: int = ROUNDS) -> DataFrame:
    """``uid, sequence_id, offset`` of every row of ``sizes`` (``uid`` unique, ``length`` from 1 to ``capacity``).

    The rows of a sequence fill it from 0 without gaps. No rows give no rows.
    """
    todo, _ = materialise(sizes.where(F.col("length") < capacity).select("uid", F.col("length").cast("long").alias("length")), "items")
    done = []
    for r in range(rounds):
        count = todo.count()
        if not count:
            break
        problems = -(-count // problem)
        packed = _search(todo, problems, capacity, r)
        # round, problem and bin make the number; a problem has far fewer than 2^20 pieces
        number = F.shiftleft(F.lit(r).cast("long"), 56) + F.shiftleft(F.col("problem"), 20) + F.col("bin")
        packed, _ = materialise(packed.withColumn("sequence_id", number), "packed")
        if r == rounds - 1 or problems == 1:
            done.append(packed)
            break
        fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
        full = fill.where(F.col("fill") >= FULL * capacity).select("sequence_id")
        done.append(packed.join(full, "sequence_id", "left_semi"))
        todo, _ = materialise(packed.join(full, "sequence_id", "left_anti").select("uid", "length"), "items")
    whole = sizes.where(F.col("length") >= capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not done:
        return whole
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = out.select("uid", "length", "sequence_id")
    placed = (out.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("rows"))
              .select("sequence_id", F.posexplode("rows").alias("n", "row"), "rows")
              .select(F.col("row.uid").alias("uid"), "sequence_id",
                      F.aggregate(F.slice("rows", F.lit(1), F.col("n")), F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("offset")))
    return whole.unionByName(placed)


def pack_documents(cut: DataFrame, capacity: int = LENGTH) -> DataFrame:
    """The columns of ``cut`` (from :func:`pieces`, without ``ids``) with ``sequence_id`` and ``offset``."""
    numbered, _ = materialise(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = pack(numbered.select("uid", "length"), capacity)
    return numbered.join(placed, "uid").drop("uid")
