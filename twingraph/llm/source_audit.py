"""Audit of how the sources of a language differ in their words, by chunk factorization.

A text is cut at white space into chunks, and the chunks of each document are counted.
Documents are taken in blocks; a block numbers its distinct chunks, deals them to
buckets by a hash, and keeps (document, chunk number, count) as packed integers. Every
globally distinct chunk meets its copies of all blocks in one bucket and is tokenized
there once; its terms go back to the blocks. A block then knows the terms of each of
its documents, and since a document lies in one block, distinct documents and
occurrences add up over blocks.

The divergence of a group of documents from another one, or from its whole language,
is summed without a row per group and term: terms that stand in one group only are
taken by their histogram of counts, and terms that stand in neither all at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_path, materialise, positive_partitions, slices, spans_gather, utf8

BLOCK_BYTES = 8 << 20  # text of a block; a longer document is a block of its own
TOGETHER = 6            # blocks that one task counts, on average
SUMMED = 500_000        # rows of counts that a task sums before it passes them on
SCALE = 1_000_000_000
# What a term does not hold: ASCII without its letters (fixed pattern; upper case is folded first).
OUTSIDE_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _squeezed(raw: bytes) -> bytes:
    """Compressed bytes behind their length; nothing for nothing."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def _restored(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True) if raw else b""


def _packed(a: np.ndarray) -> bytes:
    """Integers as four planes of bytes, which compress well: the upper planes are almost all zero."""
    return _squeezed(a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_restored(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _buckets(chunks: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for each (not empty) chunk, from a polynomial of its bytes."""
    data, off = utf8(chunks)
    if not len(chunks):
        return np.zeros(0, np.int64)
    place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    h = np.add.reduceat(data.astype(np.uint64) * powers[place], off[:-1])
    return ((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def _block(parts: list[pa.RecordBatch], buckets: int) -> dict:
    """One block: its groups, its distinct chunks by bucket, and its packed document counts.

    The documents' chunk numbers are ascending, so they are kept as differences; the first of a
    document is its number plus one.
    """
    t = pa.Table.from_batches(parts)
    langs, sources = (t[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    pair, group = np.unique(langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy(),
                            return_inverse=True)
    split = pc.ascii_split_whitespace(t["text"].combine_chunks())
    per_doc = np.asarray(pc.list_value_length(split), np.int64)
    words = split.flatten()
    there = pc.not_equal(words, "")
    doc = np.repeat(np.arange(len(per_doc)), per_doc)[np.asarray(there)]
    coded = words.filter(there).dictionary_encode()
    del split, words, there
    chunks, index = coded.dictionary, coded.indices.to_numpy()
    bucket = _buckets(chunks, buckets)
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    size = max(len(chunks), 1)
    key = number[index]
    key += doc * size
    del doc, coded, index
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    n, key = np.diff(np.append(first, len(key))), key[first]
    doc, at = np.divmod(key, size)
    gap = np.diff(at, prepend=0)
    head = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
    gap[head] = at[head] + 1
    sizes = np.bincount(bucket, minlength=buckets)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), chunks.take(pa.array(order)))
    return {"langs": langs.dictionary.take(pa.array(pair // len(sources.dictionary))).to_pylist(),
            "sources": sources.dictionary.take(pa.array(pair % len(sources.dictionary))).to_pylist(),
            "doc_group": _packed(group), "doc_size": _packed(np.bincount(doc, minlength=len(per_doc))),
            "gap": _packed(gap), "n": _packed(n), "chunks": [_squeezed(c.as_buffer().to_pybytes()) for c in pc.binary_join(lists, " ")]}


BLOCK_SCHEMA = ("block long, langs array<string>, sources array<string>, doc_group binary, doc_size binary, gap binary, n binary, "
                "chunks array<binary>")
BLOCK_ARROW = pa.schema([("block", pa.int64()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string())),
                         *[(c, pa.binary()) for c in ("doc_group", "doc_size", "gap", "n")], ("chunks", pa.list_(pa.binary()))])


def chunk_blocks(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of ``docs(lang, source, text)``: chunks counted per document, distinct chunks listed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = made = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": first + made, **_block(held, buckets)}], schema=BLOCK_ARROW)

        for big in batches:
            lens = np.asarray(pc.binary_length(big.column("text")), np.int64) if big.num_rows else np.zeros(0, np.int64)
            for a, z in slices(lens + 16, block_bytes):
                more = int(lens[a:z].sum())
                if held and size + more > block_bytes:
                    yield close()
                    pa.default_memory_pool().release_unused()
                    held, size, made = [], 0, made + 1
                held.append(big.slice(a, z - a))
                size += more
        if held:
            yield close()

    return docs.select("lang", "source", "text").mapInArrow(run, BLOCK_SCHEMA)


def _tokenize(table: pa.Table) -> pa.Table:
    """The rows of one bucket with the terms of their chunks: a line for each chunk, its terms joined by one space."""
    lists = pc.split_pattern(pa.array([_restored(c.as_py()) for c in table["chunks"]]).cast(pa.string()), " ")
    coded = lists.flatten().dictionary_encode()
    terms = pc.ascii_trim_whitespace(pc.replace_substring_regex(pc.ascii_lower(coded.dictionary), OUTSIDE_TERMS, " "))
    lines = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, terms.take(coded.indices)), "\n")
    return pa.table({"super": table["super"], "block": table["block"], "bucket": table["bucket"],
                     "lines": pa.array([_squeezed(x.as_buffer().to_pybytes()) for x in lines], pa.binary())})


def _term_counts(block: dict, lines: pa.Array, groups: dict) -> pa.Table | None:
    """``g, term, docs, n`` of one block; ``groups`` numbers the (lang, source) pairs met so far."""
    split = pc.ascii_split_whitespace(lines)
    flat = split.flatten()
    there = pc.not_equal(flat, "")
    of_chunk = np.repeat(np.arange(len(split)), np.asarray(pc.list_value_length(split), np.int64))[np.asarray(there)]
    coded = flat.filter(there).dictionary_encode()
    if not len(coded):
        return None
    code, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    per_chunk = np.bincount(of_chunk, minlength=len(split))
    group, size, gap, n = (_unpacked(block[c]) for c in ("doc_group", "doc_size", "gap", "n"))
    group = np.array([groups.setdefault(p, len(groups)) for p in zip(block["langs"], block["sources"])], np.int64)[group]
    doc = np.repeat(np.arange(len(size)), size)
    # running sums within each document give the chunk numbers back
    starts = (np.cumsum(size) - size)[size > 0]
    total = np.cumsum(gap)
    at = total - np.repeat(total[starts] - gap[starts], size[size > 0]) - 1
    many = per_chunk[at]
    term = code[spans_gather((np.cumsum(per_chunk) - per_chunk)[at], many)]
    doc, n = np.repeat(doc, many), np.repeat(n, many)
    # a document's copies of a term meet when its pairs are sorted; then the pairs of a group
    pair = doc * len(terms) + term
    order = np.argsort(pair, kind="stable")
    first = _firsts(pair[order])
    n, pair = np.add.reduceat(n[order], first), pair[order[first]]
    pair = group[pair // len(terms)] * len(terms) + pair % len(terms)
    order = np.argsort(pair, kind="stable")
    first = _firsts(pair[order])
    keys = pair[order[first]]
    return pa.table({"g": pa.array((keys // len(terms)).astype(np.int32)), "term": terms.take(pa.array(keys % len(terms))),
                     "docs": pa.array(np.diff(np.append(first, len(pair)))), "n": pa.array(np.add.reduceat(n[order], first))})


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where a run of equal sorted keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


COUNT_SCHEMA = "lang string, source string, term string, docs long, n long"
COUNT_ARROW = pa.schema([*((c, pa.string()) for c in ("lang", "source", "term")), ("docs", pa.int64()), ("n", pa.int64())])


def _count_blocks(blocks: pa.Table, lines: pa.Table) -> pa.Table:
    """The counts of a few blocks, each with the lines of all its buckets.

    One block is held at a time; counts are summed until they have ``SUMMED`` rows.
    """
    done, whole, groups = [], None, {}
    lines = lines.sort_by([("block", "ascending"), ("bucket", "ascending")])
    whose = lines["block"].to_numpy()
    for i in range(blocks.num_rows):
        block = blocks.slice(i, 1).to_pylist()[0]
        a, z = np.searchsorted(whose, [block["block"], block["block"] + 1])
        if a == z:
            continue
        text = b"\n".join(_restored(x.as_py()) for x in lines["lines"].slice(a, z - a))
        t = _term_counts(block, pc.split_pattern(pa.array([text.decode()]), "\n").flatten(), groups)
        del text
        if t is not None and whole is not None:
            t = (pa.concat_tables([whole, t]).group_by(["g", "term"]).aggregate([("docs", "sum"), ("n", "sum")])
                 .rename_columns(["g", "term", "docs", "n"]))
        whole = whole if t is None else t
        if whole is not None and whole.num_rows >= SUMMED:
            done, whole = [*done, whole], None
    done += [whole] if whole is not None else []
    names = [pa.array([p[k] for p in groups], pa.string()) for k in (0, 1)]
    # small batches: the JVM holds one of them at a time
    batches = [pa.RecordBatch.from_arrays([names[0].take(b["g"]), names[1].take(b["g"]), b["term"], b["docs"], b["n"]], schema=COUNT_ARROW)
               for t in done for b in t.to_batches(max_chunksize=50_000)]
    del done, whole
    pa.default_memory_pool().release_unused()
    return pa.Table.from_batches(batches, schema=COUNT_ARROW)


def term_counts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``lang, source, term, docs, n`` of every term of a group: its distinct documents and occurrences; and the path to drop."""
    spark = docs.sparkSession
    buckets = 2 * positive_partitions(spark)
    blocks, path = materialise(chunk_blocks(docs, buckets, block_bytes), "chunk-blocks")
    supers = max(positive_partitions(spark), -(-blocks.count() // TOGETHER))
    blocks = blocks.withColumn("super", F.pmod(F.xxhash64("block"), F.lit(supers)))
    dealt = blocks.select("super", "block", F.posexplode("chunks").alias("bucket", "chunks")).where("length(chunks) > 0")
    lines = dealt.groupBy("bucket").applyInArrow(_tokenize, "super long, block long, bucket int, lines binary")
    counted = (blocks.drop("chunks").groupBy("super").cogroup(lines.groupBy("super"))
               .applyInArrow(_count_blocks, COUNT_SCHEMA))
    return counted.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")), path


def _p(n: str, total: str) -> str:
    """1 + floor(SCALE * (n + 1) / (total + size of the vocabulary)), exact beyond 64 bits."""
    return f"(1 + (cast({n} + 1 as decimal(20,0)) * {SCALE}) div cast({total} + vocab as decimal(20,0)))"


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the divergence of each group from each other group of its language."""
    sized = groups.join(kept.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("k")), ["lang", "source"], "left")
    # z: the p of a term that the group does not hold
    sized = sized.select("lang", "source", "vocab", F.coalesce("k", F.lit(0)).alias("k"), F.expr(f"if(vocab > 0, {_p('0', 'total')}, 1)").alias("z"))
    other = sized.select("lang", F.col("source").alias("item"), F.col("k").alias("k2"), F.col("z").alias("z2"))
    both_ways = sized.join(other, "lang").where("source <> item")

    # terms of one group against the absent-term p of the other, as if the other held none of them
    histogram = kept.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("c"))
    against = histogram.join(sized.select("lang", F.col("source").alias("item"), "z"), "lang").where("source <> item")
    single = against.groupBy("lang", "source", "item").agg(F.sum(F.expr(f"c * {_f('p', 'z')}")).alias("own"),
                                                           F.sum(F.expr(f"c * {_f('z', 'p')}")).alias("others"))
    # terms that both groups hold, each pair of groups once
    a = kept.select("lang", "term", F.col("source").alias("s1"), F.col("p").alias("p1"), F.col("z").alias("z1"))
    b = kept.select("lang", "term", F.col("source").alias("s2"), F.col("p").alias("p2"), F.col("z").alias("z2"))
    met = a.join(b, ["lang", "term"]).where("s1 < s2").groupBy("lang", "s1", "s2").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum(F.expr(f"{_f('p1', 'p2')} - {_f('p1', 'z2')} - {_f('z1', 'p2')}")).alias("up"),
        F.sum(F.expr(f"{_f('p2', 'p1')} - {_f('p2', 'z1')} - {_f('z2', 'p1')}")).alias("down"))
    shared = met.select("lang", F.col("s1").alias("source"), F.col("s2").alias("item"), "m", F.col("up").alias("mend")).unionByName(
        met.select("lang", F.col("s2").alias("source"), F.col("s1").alias("item"), "m", F.col("down").alias("mend")))
    back = single.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "others")
    key = ["lang", "source", "item"]
    joined = both_ways.join(single.drop("others"), key, "left").join(back, key, "left").join(shared, key, "left")
    zero = lambda c: f"coalesce({c}, 0)"
    value = (f"{zero('own')} + {zero('others')} + {zero('mend')} "
             f"+ (vocab - k - k2 + {zero('m')}) * {_f('z', 'z2')}")
    return joined.select(*key, F.expr(value).cast("long").alias("value"))


def divergence(df: DataFrame, least_docs: int = 3, term_ranks: int = 200, lang: str = "lang", source: str = "source",
               text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) group.

    A language keeps the terms of at least ``least_docs`` of its documents. Part ``pair`` lists every other
    source of the language by the group's divergence from it, part ``term`` the ``term_ranks`` terms that
    set the group most apart from its language. All figures are exact integers.

    Each row is a document of its own, repeated rows included. Null text, lang and source are read as
    empty; an empty text counts for its group only. A language without kept terms has pairs of value 0.
    Equal values are ranked by item in byte order. Other columns are not read; an empty table gives no rows.
    """
    docs = df.select(F.coalesce(df[lang].cast("string"), F.lit("")).alias("lang"), F.coalesce(df[source].cast("string"), F.lit("")).alias("source"),
                     F.coalesce(df[text].cast("string"), F.lit("")).alias("text"))
    counts, blocks_path = term_counts(docs, block_bytes)
    word = Window.partitionBy("lang", "term")
    kept, _ = materialise(counts.withColumn("lang_docs", F.sum("docs").over(word)).withColumn("lang_n", F.sum("n").over(word))
                          .where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    drop_path(df.sparkSession, blocks_path)

    whole = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("vocab"), F.sum("n").alias("lang_total"))
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (docs.select("lang", "source").distinct().join(whole, "lang", "left").join(held, ["lang", "source"], "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("vocab", "lang_total", "total")]))
    groups, _ = materialise(groups, "audit-groups")
    scored = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", F.expr(_p("n", "total")).alias("p"), F.expr(_p("0", "total")).alias("z"), F.expr(_p("lang_n", "lang_total")).alias("q"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (scored.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          F.expr(_f("p", "q")).alias("value"))
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= term_ranks))
    pairs = _pairs(scored.drop("q"), groups).withColumn("rank", F.row_number().over(best))
    return terms.unionByName(pairs.withColumn("part", F.lit("pair"))).select("lang", "source", "part", "item", "value", "rank")
