"""BPE with word ends, encoded by forced boundaries, and its decoding.

A merge can only join two symbols that stand side by side inside some token. Where a
pair of neighbouring bytes occurs inside no token of the vocabulary, no merge ever
crosses it: the place is a certain cut. A word is split at its cuts, each distinct
fragment is merged on its own, and the ids of a word are those of its fragments, one
after the other. A byte that ends a word is a symbol of its own (``</w>``).

The vocabulary is a public ``tokenizers`` file, whose own normaliser and split pattern
make the words; the merges are made here. A task cuts whole batches of words at once,
and merges all distinct fragments together, one merge of each fragment a round.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

from .common import slices, small_batches, spans_gather, utf8
from .packing import PLAIN, SPLIT

END = "</w>"
STOP = 255            # ends a word in the byte stream; no UTF-8 text holds this byte
NEVER = np.iinfo(np.int32).max
LONG = 64             # fragments with more symbols go through a heap
WORDS_KEPT = 300_000  # words that a worker remembers
BATCH_BYTES = 8 << 20
BATCH_IDS = 1 << 20


def byte_letters() -> list[str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Merges:
    """Symbols, merges and certain cuts of a vocabulary. Symbol ``b`` is a byte, ``256 + b`` one that ends a word."""

    def __init__(self, model: dict):
        vocab, letters = model["vocab"], byte_letters()
        number = {c: b for b, c in enumerate(letters)}
        missing = [c for c in letters if c not in vocab or c + END not in vocab]
        if missing or model.get("end_of_word_suffix") != END or model.get("continuing_subword_prefix"):
            raise ValueError("not a byte-level vocabulary with word ends")
        self.first = np.array([vocab[c] for c in letters] + [vocab[c + END] for c in letters], np.int32)
        self.joined = np.zeros((256, 512), bool)  # pairs of symbols that stand inside some token
        for t in vocab:
            # a token that ends in the suffix may also hold its letters as such: both readings count
            for body, ends in ((t, 0), (t.removesuffix(END), 256))[:1 + t.endswith(END)]:
                b = [number[c] for c in body]
                if len(b) > 1:
                    self.joined[b[:-1], b[1:]] = True
                    self.joined[b[-2], b[-1] + ends] = True
        rules = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in rules] or [-1], np.int64)
        made = np.array([vocab[a + b] for a, b in rules] or [-1], np.int32)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of two tokens, ``NEVER`` if there is none."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def fragments(self, stream: np.ndarray) -> np.ndarray:
        """Starts of the fragments of words that each end in ``STOP``, and the stream's length."""
        if not len(stream):
            return np.zeros(1, np.int64)
        left, right = stream[:-1], stream[1:]
        last = np.append(stream[2:] == STOP, False)
        cut = left == STOP
        both = ~cut & (right != STOP)
        cut[both] = ~self.joined[left[both], right[both] + 256 * last[both]]
        return np.concatenate(([0], np.flatnonzero(cut) + 1, [len(stream)]))

    def encode(self, fragments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct fragments, concatenated, and the number of ids of each."""
        off = np.frombuffer(fragments.buffers()[1], np.int64, len(fragments) + 1, 8 * fragments.offset)
        raw = np.frombuffer(fragments.buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        stop = raw == STOP
        lens = np.diff(off) - np.add.reduceat(stop, off[:-1])
        symbol = raw + 256 * np.append(stop[1:], False).astype(np.int32)
        ids = self.first[symbol[~stop]]
        many = np.flatnonzero(lens > LONG)
        short = lens <= LONG
        start = np.cumsum(lens) - lens
        done = [self._rounds(ids[np.repeat(short, lens)], lens[short], np.flatnonzero(short))]
        done += [(np.full(len(x), f), x) for f in many.tolist() for x in [self._heap(ids[start[f]:start[f] + lens[f]].tolist())]]
        owner, out = (np.concatenate(x) for x in zip(*done))
        return out[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lens))

    def _rounds(self, ids: np.ndarray, lens: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each round makes the leftmost merge of lowest rank in every fragment that still has one."""
        owner = np.repeat(who, lens)
        rank = np.full(len(ids), NEVER, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank(ids[inner], ids[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(ids))))
            over = lowest == NEVER
            if over.any():
                done.append((owner[over], ids[over]))
                ids, owner, rank, lowest = ids[~over], owner[~over], rank[~over], lowest[~over]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == lowest)
            at = at[np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))]
            ids[at] = self.made[rank[at]]
            left = np.ones(len(ids), bool)
            left[at + 1] = False
            ids, owner, rank = ids[left], owner[left], rank[left]
            at = at - np.arange(len(at))  # every fragment has lost one symbol
            for p in (at, at[at > 0] - 1):
                some = p[p + 1 < len(ids)]
                same = owner[some] == owner[some + 1]
                rank[p] = np.where(owner[p] == owner[np.minimum(p + 1, len(ids) - 1)], rank[p], NEVER)
                rank[some[same]] = self.rank(ids[some[same]], ids[some[same] + 1])
                rank[p[p + 1 >= len(ids)]] = NEVER
        return (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int32))

    def _heap(self, ids: list[int]) -> np.ndarray:
        """The same merges of one long fragment, in n log n."""
        n = len(ids)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        table = self._table()
        queue = [(r, i) for i in range(n - 1) if (r := table.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            if not alive[i] or nxt[i] >= n or table.get((ids[i], ids[nxt[i]])) != r:
                continue
            j = nxt[i]
            ids[i], alive[j], nxt[i] = int(self.made[r]), False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for a in (prv[i], i):
                if a >= 0 and nxt[a] < n and (q := table.get((ids[a], ids[nxt[a]]))) is not None:
                    heapq.heappush(queue, (q, a))
        return np.array([x for x, there in zip(ids, alive) if there], np.int32)

    def _table(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_by_pair"):
            self._by_pair = {(k >> 32, k & 0xFFFFFFFF): r for k, r in zip(self.keys.tolist(), self.ranks.tolist())}
        return self._by_pair


class Encoder:
    """Encodes texts by one file; remembers a bounded number of words between calls."""

    def __init__(self, raw: str):
        file = json.loads(raw)
        self.merges, self.normalizer = Merges(file["model"]), Tokenizer.from_str(raw).normalizer
        split = file["pre_tokenizer"]["pretokenizers"][0]
        self.split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.flat, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _pieces(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Split words (null: a special token) of distinct white-space words, and their number for each."""
        special = np.asarray(pc.match_substring_regex(words, self.special_at.pattern)) if self.special else np.zeros(len(words), bool)
        plain = np.asarray(pc.match_substring_regex(words, PLAIN)) & ~special
        lower = pc.utf8_lower(words.filter(pa.array(plain)))
        parts = pc.ascii_split_whitespace(pc.utf8_rtrim_whitespace(pc.replace_substring_regex(lower, SPLIT, r"\1 ")))
        alone: list[list[str]] = []
        for w in words.filter(pa.array(~plain)).to_pylist():
            found: list[str] = []
            for k, part in enumerate(self.special_at.split(w) if self.special else [w]):
                if k % 2:
                    found.append("\0" + part)  # marks a special token; no piece starts with it alone
                elif part:
                    found += [p for p, _ in self.split.pre_tokenize_str(self.normalizer.normalize_str(part))]
            alone.append(found)
        count = np.zeros(len(words), np.int64)
        count[plain] = np.asarray(pc.list_value_length(parts), np.int64)
        count[~plain] = [len(x) for x in alone]
        both = pa.concat_arrays([parts.flatten(), pa.array([p for x in alone for p in x], pa.large_string())])
        from_plain = np.repeat(plain, count)
        place = np.empty(len(both), np.int64)
        place[from_plain], place[~from_plain] = np.arange(from_plain.sum()), from_plain.sum() + np.arange((~from_plain).sum())
        return both.take(pa.array(place)), count

    def _learn(self, words: pa.Array) -> None:
        pieces, count = self._pieces(words)
        kept = pieces.filter(pc.invert(self._is_special(pieces)))
        stream, per_piece = _ended(kept)
        starts = self.merges.fragments(stream)
        column = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(stream)])
        coded = column.dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary())
        ids, n_ids = self.merges.encode(distinct) if len(distinct) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        frag = coded.indices.to_numpy()
        # ids of the pieces: those of their fragments, one after the other
        flat = ids[spans_gather((np.cumsum(n_ids) - n_ids)[frag], n_ids[frag])]
        running = np.concatenate(([0], np.cumsum(n_ids[frag])))
        piece_ends = running[np.searchsorted(starts, np.concatenate(([0], np.cumsum(per_piece))))]
        sizes = np.diff(piece_ends)
        if len(kept) < len(pieces):
            flat, sizes = self._with_special(pieces, flat, sizes)
        self.known = pa.concat_arrays([self.known, words])
        self.flat = np.concatenate((self.flat, flat.astype(np.int32)))
        per_word = np.diff(np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(count)))])
        self.lens = np.concatenate((self.lens, per_word))

    def _is_special(self, pieces: pa.Array) -> pa.Array:
        if not self.special:
            return pa.array(np.zeros(len(pieces), bool))
        return pc.is_in(pieces, value_set=pa.array(["\0" + s for s in self.special], pa.large_string()))

    def _with_special(self, pieces: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        special = np.asarray(self._is_special(pieces))
        own = np.array([self.special[p[1:]] for p in pieces.filter(pa.array(special)).to_pylist()], np.int32)
        size, start = np.ones(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        size[~special], start[~special] = sizes, np.cumsum(sizes) - sizes
        start[special] = len(flat) + np.arange(len(own))
        return np.concatenate((flat, own))[spans_gather(start, size)], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and offsets by text. No word crosses ASCII white space."""
        if len(self.known) > WORDS_KEPT:
            self._forget()
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = split.flatten().dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.known)
        if at.null_count:
            self._learn(coded.dictionary.filter(at.is_null()))
            at = pc.index_in(coded.dictionary, value_set=self.known)
        word = at.to_numpy(zero_copy_only=False).astype(np.int64)[coded.indices.to_numpy()]
        size = self.lens[word]
        ids = self.flat[spans_gather((np.cumsum(self.lens) - self.lens)[word], size)]
        bounds = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(split), np.int64))))
        return ids, np.concatenate(([0], np.cumsum(size)))[bounds]


def _ended(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces, each followed by ``STOP``, and the number of bytes of each with it."""
    data, off = utf8(pieces)
    lens = np.diff(off)
    stream = np.full(int(lens.sum()) + len(pieces), STOP, np.uint8)
    keep = np.ones(len(stream), bool)
    keep[np.cumsum(lens + 1) - 1] = False
    stream[keep] = data
    return stream, lens + 1


@lru_cache(maxsize=2)
def encoder(raw: str) -> Encoder:
    """One encoder for a Python worker, so that its tasks share the words that it remembers."""
    return Encoder(raw)


def encode(df: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None, out: str = "ids") -> DataFrame:
    """Append ``out`` (array of token ids, none added) to the ``keep`` columns of ``df``.

    The strings of special tokens in a text are those tokens, as the file's library reads them by default.
    Null and empty texts give an empty array; repeated rows stay; other columns, whatever their names, are
    neither read nor shipped; an empty table stays empty. The file has a fixed size and is broadcast.
    """
    keep = keep if keep is not None else ["doc_id"]
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    source = df.select(*keep, df[text].cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(raw.value)
        for big in batches:
            for b in small_batches(big, "_text", BATCH_BYTES):
                ids, off = coder.encode(b.column("_text"))
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], names=[*keep, out])

    return source.mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _tokens(raw: str) -> pa.Array:
    file = json.loads(raw)
    by_id = {i: t for t, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
    return pa.array([by_id.get(i) for i in range(max(by_id) + 1)])


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append ``out``: the tokens of the ids, special ones too, joined by one space, as a file without a decoder reads.

    A null array gives an empty string; null ids and ids outside the vocabulary give nothing.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = f.read()
    if json.loads(raw).get("decoder"):
        raise ValueError("the file has a decoder of its own")
    shared = df.sparkSession.sparkContext.broadcast(raw)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType(), False)])
    names = [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        for big in batches:
            sizes = np.asarray(pc.list_value_length(big.column(ids)).fill_null(0), np.int64)
            for a, z in slices(sizes + 1, BATCH_IDS):
                b = big.slice(a, z - a)
                col = b.column(ids).fill_null([]) if b.column(ids).null_count else b.column(ids)
                at = col.flatten()
                known = pc.and_(pc.greater_equal(at, 0), pc.less(at, len(tokens))).fill_null(False)
                words = tokens.take(pc.if_else(known, at, None))
                off = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(col), np.int64))))
                if words.null_count:
                    there = np.asarray(words.is_valid())
                    off, words = np.concatenate(([0], np.cumsum(there)))[off], words.drop_null()
                texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), words), " ")
                yield pa.RecordBatch.from_arrays([*b.columns, texts], names=names)

    return df.mapInArrow(run, schema)

