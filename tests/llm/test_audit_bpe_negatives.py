"""Source audit, forced-boundary BPE and hard negatives against plain versions."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from twingraph.llm import chat, forced_bpe, hard_negatives, source_audit
from twingraph.llm.queries import WORD_BPE, queries

from .test_text_operators import ODD, frame, noise

SF = "/root/testdata/sf0.001"


# --- source audit -------------------------------------------------------------------

def plain_audit(rows, least, ranks):
    """``(lang, source, part, item, value, rank)`` of ``rows`` (lang, source, text), straight from the definition."""
    docs = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
            for a, b, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= least}
        count = {s: collections.Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        whole = collections.Counter(t for d in own for t in d[2] if t in kept)

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(a, b):
            return (a - b) * (a - b) // b

        for s, c in count.items():
            pair = [(o, sum(f(p(c, t), p(d, t)) for t in kept)) for o, d in count.items() if o != s]
            term = [(t, f(p(c, t), p(whole, t))) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, items, most in (("pair", pair, len(pair)), ("term", term, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 20])
def test_audit_against_plain(spark, block_bytes):
    rng = random.Random(4)
    words = ["Ab", "ab", "zé", "ÉTÉ", "x1y", "a-b", "日本", "q r", "don't", "--", "…", "Z"] + [f"w{chr(97 + i)}" for i in range(15)]
    rows = [(rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s1", "s2", "s3", None]),
             rng.choice([" ", "\t", "\n "]).join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for _ in range(120)]
    rows += [("fr", "a", "une fois"), ("fr", "b", None), ("fr", "c", ""), ("en", "void", ""), ("it", "one", "x x x"),
             ("en", "s1", "ab,ab.AB;" * 400), ("en", "s1", "\x1fab\x00Ab" * 50)] + [rows[3]] * 3
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr(
        "*", "1 as block", "'n' as term", "2 as n", "3 as p", "'v' as value", "4 as vocab", "1 as doc_id")
    out = sorted(map(tuple, source_audit.divergence(df, least_docs=3, term_ranks=5, block_bytes=block_bytes).collect()))
    assert out == plain_audit(rows, 3, 5)


def test_audit_empty_table(spark):
    assert source_audit.divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_audit_packs_integers():
    for a in ([], [0], [5, 2**32 - 1, 7], list(range(1000))):
        assert source_audit._unpacked(source_audit._packed(np.array(a, np.int64))).tolist() == a


def test_audit_terms_stay_whole_chunks(spark):
    """No term lies on both sides of ASCII white space, so chunks can be tokenized alone."""
    every = "".join(map(chr, range(128)))
    assert not set(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", every)[0]) & set(" \t\n\r\x0b\x0c")
    df = spark.createDataFrame([("en", "s", every)] * 3, "lang string, source string, text string")
    assert [r.item for r in source_audit.divergence(df).collect()] == []  # one group: nothing sets it apart
    counts, _ = source_audit.term_counts(df)
    assert [tuple(r) for r in counts.collect()] == [("en", "s", "abcdefghijklmnopqrstuvwxyz", 3, 6)]


# --- forced-boundary BPE ------------------------------------------------------------

SPECIAL = ["a<|endoftext|>b<|startoftext|>", "<|endoftext|><|endoftext|>", "<|EndOfText|>", "<|endoftext", "x <|endoftext|>", "\0<|endoftext|>"]


def test_forced_bpe_equals_tokenizers(spark):
    tok = Tokenizer.from_file(WORD_BPE)
    texts = ODD + SPECIAL + noise(300) + noise(300, "aBé'sΣ \n1́!İ\x1c <|ŁЖ…日ﬁﷺ‍") + ["ab" * 900 + "é" * 300, "</w> x</w>y"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    df = frame(spark, texts, extra=True).withColumn("decoded", F.lit(1)).withColumn("_text", F.lit(2))
    out = forced_bpe.decode(forced_bpe.encode(df, WORD_BPE), WORD_BPE).collect()
    assert len(out) == len(texts)
    for r in out:
        want = tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == want
        assert r.decoded == tok.decode(want, skip_special_tokens=False)
    assert forced_bpe.encode(df.limit(0), WORD_BPE).count() == 0


def test_forced_bpe_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(forced_bpe, "WORDS_KEPT", 3)
    raw = open(WORD_BPE, encoding="utf-8").read()
    coder, tok = forced_bpe.Encoder(raw), Tokenizer.from_str(raw)
    for text in ["one two three", "two four five six", "one", ""]:
        ids, off = coder.encode(pa.array([text, None, text]))
        want = tok.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and off.tolist() == [0, len(want), len(want), 2 * len(want)]


def test_cuts_are_where_no_token_has_the_pair():
    import json
    model = json.loads(open(WORD_BPE, encoding="utf-8").read())["model"]
    merges = forced_bpe.Merges(model)
    words = [b"hello", b"qzxjq", "日本語".encode(), b"x", b"zzqqwwkk"]
    stream = np.frombuffer(b"".join(w + b"\xff" for w in words), np.uint8)
    starts = merges.fragments(stream)
    pieces = [bytes(stream[a:z]) for a, z in zip(starts, starts[1:])]
    assert b"".join(pieces) == stream.tobytes() and len(pieces) > len(words)
    letters = forced_bpe.byte_letters()
    tokens = list(model["vocab"])
    for left, right in zip(pieces, pieces[1:]):
        if left.endswith(b"\xff"):
            continue
        ends = right[1:2] == b"\xff"
        pair = letters[left[-1]] + letters[right[0]] + ("</w>" if ends else "")
        assert not any(pair in t for t in tokens)


def test_long_fragments_merge_like_short_ones():
    import json
    merges = forced_bpe.Merges(json.loads(open(WORD_BPE, encoding="utf-8").read())["model"])
    rng = random.Random(8)
    for _ in range(40):
        word = bytes(rng.choice(b"aeinrst") for _ in range(rng.randint(2, 60)))
        ids = merges.first[np.frombuffer(word, np.uint8)]
        owner, out = merges._rounds(ids.copy(), np.array([len(ids)]), np.array([0]))
        assert out.tolist() == merges._heap(ids.tolist()).tolist() and set(owner.tolist()) == {0}


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([(1, [320, None, 49407, 99999, -1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    tok = Tokenizer.from_file(WORD_BPE)
    out = {r.doc_id: r.decoded for r in forced_bpe.decode(df, WORD_BPE).collect()}
    assert out == {1: tok.decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}


def test_op12_over_documents(spark):
    import hashlib
    tok = Tokenizer.from_file(WORD_BPE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries()["op12_forced_boundary_bpe"](spark, SF).collect()
    assert {r.doc_id for r in out} == set(texts) and len(out) == len(texts)
    for r in out:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# --- hard negatives -----------------------------------------------------------------

@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 0, 4), (0, 3, 2), (33, 35, 37), (64, 64, 64), (70, 129, 41), (256, 64, 300)])
def test_strassen_equals_the_product(shape):
    rng = np.random.default_rng(1)
    m, k, n = shape
    a, b = rng.integers(-2**27, 2**27, (m, k)), rng.integers(-2**27, 2**27, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=4) == (a.astype(object) @ b.astype(object) if k else np.zeros((m, n), int))).all()


def plain_negatives(rows, every, positives, negatives):
    best = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v:
            best[i] = min(best.get(i, (label, v)), (label, v))
    clamp = lambda x: max(-(2**63 - 2), min(2**63 - 1, x))
    out = []
    for a, (label, v) in best.items():
        if a % every:
            continue
        scored = sorted((-clamp(sum(x * y for x, y in zip(v, w))), i, m) for i, (m, w) in best.items() if i != a and len(w) == len(v))
        for ps, p in [(-s, i) for s, i, m in scored if m == label][:positives]:
            found = [(i, -s) for s, i, m in scored if m != label and 50 * ps <= 100 * -s <= 95 * ps][:negatives]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("cells", [{}, {"group": 40, "block": 3}])
def test_hard_negatives_against_plain(spark, cells):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 4)) if i % 3 else 0, rng.integers(-6, 9, 7).tolist()) for i in range(300)]
    rows += [(300 + i, (rows[i][1] + 1) % 4, rows[i][2]) for i in range(60)]  # ties over labels
    rows += [(400, None, [1] * 7), (410, 1, None), (420, 1, [1] * 6 + [None]), (None, 1, [1] * 7), (430, 2, [0] * 7), (440, 9, [3] * 7),
             (450, 1, [5, 5]), (451, 1, [4, 4]), (452, 2, [3, 3]), (460, 1, []), (461, 1, []), (462, 2, []), (470, 77, [1] * 7)]
    rows += [rows[10], (10, 3, [9] * 7), (480, 5, [-4] * 7), (481, 5, [4] * 7)]
    big = [(1000 + 10 * i, i % 2, [2**40 + i * 2**36, 2**39]) for i in range(6)]  # scores beyond a long
    df = spark.createDataFrame(rows + big, "vec_id long, label int, vector array<long>").selectExpr(
        "*", "1 as id", "2 as v", "3 as part", "4 as g", "5 as score", "true as is_anchor", "6 as kind", "7 as n")
    out = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, positives=4, negatives=3, **cells).collect()
    assert sorted(map(tuple, out)) == plain_negatives(rows + big, 10, 4, 3)


def test_hard_negatives_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, vector array<long>")
    assert hard_negatives.mine(df, F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, 1, [1, 2])], "vec_id long, label int, vector array<long>")
    assert hard_negatives.mine(alone, F.col("vec_id") % 50 == 0).count() == 0


def test_merged_heaps_keep_the_best_with_smaller_ids_first():
    none, no = hard_negatives.NONE, hard_negatives.NO_ID
    s, i = hard_negatives.merge_heaps(np.array([[9, 7, none]]), np.array([[4, 8, no]]), np.array([[9, 7, 7]]), np.array([[2, 1, 9]]))
    assert s.tolist() == [[9, 9, 7]] and i.tolist() == [[2, 4, 1]]


# --- long conversations ---------------------------------------------------------------

@pytest.mark.parametrize("numbers", ["id", "cast(null as long)", "7", "id div 100"])
def test_chat_long_conversations_read_back(spark, numbers):
    """Thousands of turns, numbered, without numbers, or tied; ties go by role, then text."""
    n = 5000
    df = spark.range(n).selectExpr("1 as conv_id", f"{numbers} as turn", "if(id % 5 < 2, 'user', 'assistant') as role",
                                   "concat('t<|', lpad(id, 6, '0'), '\\\\') as text")
    rows = sorted((-1 if r.turn is None else r.turn, r.role, r.text) for r in df.collect())
    out = chat.format_conversations(df).select(
        chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [(t.role, t.text) for t in out.turns] == [(a, b) for _, a, b in rows]
    assert out.loss == "".join(b for _, a, b in rows if a == "assistant")
