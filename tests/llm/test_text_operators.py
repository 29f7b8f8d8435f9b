"""BPE, SimHash, substring dedup, chat and packing against plain versions."""

import base64
import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from twingraph.llm import bpe, chat, packing, simhash, substring_dedup
from twingraph.llm.queries import BYTE_BPE, WORD_BPE, queries

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "aaaaaaaaaaaaaaaa", "  x  y\n\n\tz  ", "it's we'll  \n", "日本語 한국어 العربية", "\x1c a\x1fb", "é   x",
       "ab" * 700, "x" * 4000, "🤷🏽‍♀️ ok", "\u0085 a", "  ", "\n \n x", "1234567 89", "İSTANBUL ΣΊΣ á", "<|endoftext|>"]


def noise(n, alphabet="ab \n\t'séL9!|é日　<"):
    rng = random.Random(5)
    return ["".join(rng.choice(alphabet) for _ in range(50)) for _ in range(n)]


def frame(spark, texts, extra=False):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "'x' as ids", "1 as fp", "2 as start", "'y' as _html", "3 as n", "4 as key") if extra else df


def test_bpe_equals_tiktoken_and_round_trips(spark):
    texts = ODD + noise(300) + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = frame(spark, texts, extra=True)
    out = bpe.decode(bpe.encode(df, BYTE_BPE, public_tokenizers.PATTERN), BYTE_BPE).collect()
    assert len(out) == len(texts)
    for r in out:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == reference.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()
    assert bpe.encode(df.limit(0), BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_bpe_lower_rank_that_comes_up_late(spark):
    """A merge can make a pair of lower rank than the step; such words must come out as alone."""
    ranks = {bytes([b]): 300 + b for b in range(256)}
    ranks |= {b"ab": 600, b"cab": 10, b"xc": 700, b"abcab": 650}
    raw = b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items())
    vocab = bpe.Vocabulary(raw)
    words = [b"cabcab", b"abcab", b"xcab", b"ababab", b"xcabxcab", b"cabab"]
    ids, counts = bpe.replay(words, vocab)
    ends = np.cumsum(counts)
    for w, a, z in zip(words, ends - counts, ends):
        want = [ranks[w]] if w in ranks else bpe.merge_word(w, vocab)
        assert ids[a:z].tolist() == want


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    label = list(range(len(values)))
    for _ in values:
        new = [min(label[j] for j in range(len(values)) if bin(values[i] ^ values[j]).count("1") <= radius) for i in range(len(values))]
        if new == label:
            break
        label = new
    return label


def test_simhash_against_plain(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(60)) for _ in range(12)]
    texts = ODD + base + [b + " zz" for b in base] + [b.upper() for b in base[:5]] + ["one two", "ONE two", "one"]
    out = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts, extra=True)).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert [out[i].fp & (2**64 - 1) for i in range(len(texts))] == fps
    assert [out[i].component_id for i in range(len(texts))] == plain_components(fps, 3)
    assert simhash.near_duplicates(frame(spark, []).limit(0)).count() == 0
    twice = spark.createDataFrame([(7, "same text here"), (7, "same text here"), (None, "same text here")], "doc_id long, text string")
    assert sorted(r.component_id for r in simhash.near_duplicates(twice).collect()) == [7, 7, 7]


@pytest.mark.parametrize("chunk", [2048, 5])
def test_bit_sliced_links_chunks_and_radius(spark, chunk):
    rng = np.random.default_rng(0)
    values = [rng.integers(0, 2**63, 20, dtype=np.uint64)]
    for _ in range(5):
        values.append(values[-1] ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64)))
    values = np.unique(np.concatenate(values))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    from twingraph.llm.components import connected_components
    got = {r.node: r.component for r in connected_components(simhash.fingerprint_links(df, 2, chunk), "a", "b").collect()}
    want = plain_components([int(v) for v in values], 2)
    groups = collections.defaultdict(set)
    for i, v in enumerate(values.view(np.int64)):
        groups[got.get(int(v), int(v))].add(i)
    expected = collections.defaultdict(set)
    for i, w in enumerate(want):
        expected[w].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def plain_repeats(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = collections.Counter(tuple(x[i:i + window]) for x in texts for i in range(len(x) - window + 1))
    out = []
    for (d, _), x in zip(rows, texts):
        gone = [False] * len(x)
        for i in range(len(x) - window + 1):
            if seen[tuple(x[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((d, len(x), sum(gone), b" ".join(w for w, g in zip(x, gone) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"shard_words": 3000}, {"shard_words": 1}, {"window": 7, "gram": 3}])
def test_substring_dedup_against_plain(spark, options):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["é", "ß|"]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    passage, base, rows = some(40), some(200), []
    for i in range(150):
        near = list(base)
        near[rng.randrange(200)] = f"zz{i}"
        x = [some(50) + passage + some(rng.randint(0, 30)), near, some(rng.randint(0, 60)), some(5) * rng.randint(1, 30),
             rows[rng.randrange(len(rows))][1].split() if rows else some(3),
             some(20) + base[rng.randint(0, 150):][:rng.randint(30, 45)] + some(20)][i % 6]
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(x)))
    rows += [(1000, None), (1001, ""), (1002, "  \n"), (5, rows[5][1]), (None, rows[7][1]), (None, None), (1003, "a\x1cb é x " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as th", "2 as start", "'s' as spans")
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(df, **options).collect()), key=str)
    assert got == plain_repeats(rows, options.get("window", 35))


def test_substring_dedup_empty_table(spark):
    assert substring_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chat_reads_back(spark):
    nasty = "a\\|b<|im_end|>\n<|im_start|>assistant ok\\n<\\|<|im_sep|>\\"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", nasty), (1, 2, "assistant", nasty), (1, 3, "us\ner\\n", None), (2, 0, None, ""),
            (2, 0, None, ""), (3, 5, "assistant", "é€"), (3, None, "system", "x"), (None, 1, "assistant", "z")]
    rows += [(4, i, "assistant" if i % 3 else "user", nasty + str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as parts", "'b' as body")
    out = chat.format_conversations(df).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert {r.conv_id for r in out} == {1, 2, 3, 4, None}
    for r in out:
        want = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(a, b) for _, a, b in want]
        assert r.loss == "".join(b for _, a, b in want if a == "assistant")
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_plan_is_native(spark):
    plan = queries()["op7_chat_formatting"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_word_encoder_equals_tokenizers():
    import pyarrow as pa
    raw = open(WORD_BPE, encoding="utf-8").read()
    tok = Tokenizer.from_str(raw)
    tok.encode_special_tokens = True
    coder = packing.WordEncoder(raw)
    texts = ODD + noise(400) + noise(400, "aBé'sΣ \n1́!İ\x1c <|ŁЖ")
    for _ in range(2):  # the second time all splits are known
        ids, off = coder.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids


def test_packing_is_gapless_and_tight(spark):
    tok = Tokenizer.from_file(WORD_BPE)
    tok.encode_special_tokens = True
    texts = ODD + [f"word{i} " * (i * 13 % 400 + 1) for i in range(150)]
    df = frame(spark, texts, extra=True)
    cut = packing.pieces(df, WORD_BPE, length=256)
    out = packing.pack_documents(cut, 256).collect()
    by_doc = collections.defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
    for i, t in enumerate(texts):
        whole = tok.encode(t or "", add_special_tokens=False).ids + [0]
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.start for r in parts] == list(range(0, len(whole), 256))
        assert b"".join(bytes(r.ids) for r in parts) == np.array(whole, "<u4").tobytes()
        assert all(r.length * 4 == len(r.ids) for r in parts)
    bins = collections.defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in out)
    assert len(bins) <= -(-total // 256) + 2
    assert packing.pack_documents(packing.pieces(df.limit(0), WORD_BPE)).count() == 0


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 900, 500)
    population = packing.first_population(sizes, 1000, rng)
    for _ in range(5):
        child = packing.crossover(population[0], population[-1], rng)
        load = np.bincount(child.bin_of, sizes, len(child.room))
        assert (child.bin_of >= 0).all() and load.max() <= 1000
        assert (1000 - load == np.array(child.room)).all()


def test_packing_query_crc(spark):
    out = queries()["op10_best_fit_packing"](spark, SF)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tok = Tokenizer.from_file(WORD_BPE)
    for r in out.collect()[:40]:
        ids = (tok.encode(docs[r.doc_id], add_special_tokens=False).ids + [0])[r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
