"""The learned operators and the packing against plain versions: naive matching, direct normal equations, an optimum."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from twingraph.llm import calibration, packing, quality, toxicity
from twingraph.llm.queries import queries, toxic_held_out

MID = "/root/testdata/sf0.01"


def plain_raw(text, weights, exceptions):
    """Every place of every term by search; one hit a word start, the heaviest, none inside an exception."""
    folded = toxicity.fold(text)

    def places(term):
        return [i for i in range(len(folded)) if folded.startswith(term, i)]

    spared = [(i, i + len(toxicity.fold(e))) for e in exceptions for i in places(toxicity.fold(e))]
    best = {}
    for term, w in weights.items():
        for i in places(term):
            if i not in best or w > best[i][0]:
                best[i] = (w, i + len(term))
    total = sum(w for i, (w, z) in best.items() if not any(a <= i and z <= b for a, b in spared))
    return total / np.sqrt(max(folded.count(" ") - 1, 1)) if total else 0.0


def test_matcher_equals_naive_matching():
    rng = random.Random(2)
    words = ["trash", "can", "idiot", "1d10t", "scum", "line", "IDIOTS", "мoron", "a", "trashy", "$cum", "clean", "x-ray", "é"]
    weights = {" trash ": 2.0, " idio": 1.5, " idiot ": 3.0, " scum": 0.7, " moron ": 1.1, " can ": 0.2}
    exceptions = ("trash can", "scum line")
    matcher = toxicity.Matcher(weights, exceptions)
    for _ in range(400):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 12)))
        assert matcher.raw(text) == pytest.approx(plain_raw(text, weights, exceptions))


def test_lexicon_counts_equal_plain_counts(spark):
    """Every term of the lexicon stands in the texts as often as counted plainly: its weight is the log odds of these counts."""
    rng = random.Random(6)
    rows = [(" ".join(rng.choice(["bad", "ugly", "slurry", "tree", "house", "walk", "badge"]) for _ in range(6)), rng.randint(0, 1)) for _ in range(200)]
    rows = [(t + (" vile" if toxic else ""), toxic) for t, toxic in rows]
    weights = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    once = {}
    for t, toxic in rows:
        once[t] = max(once.get(t, 0), toxic)
    sizes = [sum(1 for v in once.values() if v == k) for k in (0, 1)]
    assert weights and any("vil" in t for t in weights)
    for term, w in weights.items():
        clean, toxic = (sum(term in toxicity.text_terms(t) for t, v in once.items() if v == k) for k in (0, 1))
        assert w == pytest.approx(np.log((toxic + 0.5) / (sizes[1] + 1)) - np.log((clean + 0.5) / (sizes[0] + 1)))


def test_toxic_held_out_recall(spark):
    """Better than answering 0 everywhere: toxic held-out texts are found, clean ones left alone."""
    out = queries()["op5_toxicity"](spark, MID).where("held_out").join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id")
    r = out.agg(F.sum("toxic").alias("toxic"), F.sum(F.col("toxic") * F.col("predicted")).alias("hit"),
                F.sum((1 - F.col("toxic")) * F.col("predicted")).alias("wrong"), F.count("*").alias("n")).first()
    assert r["hit"] >= 0.6 * r["toxic"] and r["wrong"] <= 0.02 * r["n"]


def test_normal_equations_equal_direct_sums(spark):
    rng = np.random.default_rng(3)
    width = len(quality.STATISTICS)
    stats, y = rng.standard_normal((700, width)).astype(np.float32), rng.integers(0, 2, 700)
    model = quality.QualityModel(stats.mean(axis=0).astype(float), stats.std(axis=0).astype(float), None, None)
    df = spark.createDataFrame([(s.tolist(), int(v)) for s, v in zip(stats, y)], "stats array<float>, label int").repartition(7)
    gram, right = quality._normal_equations(df, model, "label")
    z = model.features(stats.astype(np.float64))
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)
    gram0, right0 = quality._normal_equations(df.where("false"), model, "label")
    assert gram0.shape == gram.shape and not right0.any()


def test_isotonic_fit_equals_plain_pooling():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = int(rng.integers(1, 30))
        rows = rng.integers(1, 6, n).astype(float)
        ones = np.array([rng.integers(0, int(k) + 1) for k in rows], float)
        fit = calibration.pool_adjacent(ones, rows)
        # the max-min formula of isotonic regression
        plain = [max(min(ones[a:z].sum() / rows[a:z].sum() for z in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(fit, plain)


def least_bins(sizes, capacity):
    """The optimum by trying every partition of few items."""
    best = len(sizes)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + rest[0] <= capacity and bins[i] not in bins[:i]:
                place(rest[1:], [*bins[:i], bins[i] + rest[0], *bins[i + 1:]])
        place(rest[1:], [*bins, rest[0]])

    place(sorted(sizes, reverse=True), [])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_packing_reaches_the_optimum_of_few_pieces(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.randint(15, 70) for _ in range(11)]
    df = spark.createDataFrame([(i % 4, 0, 0, s, 1) for i, s in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack_documents(df, 100).collect()
    assert len(out) == 11 and len({r.sequence_id for r in out}) == least_bins(sizes, 100)
    for _, group in itertools.groupby(sorted(out, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 100


def test_packing_of_repeated_rows_and_null_ids(spark):
    rows = [(None, 0, 0, 40, 1), (None, 0, 0, 40, 1), (5, 0, 0, 60, 2), (5, 0, 0, 60, 2), (None, 1, 40, 100, 3)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack_documents(df, 100).collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length) for r in out) == sorted((d or -1, p, s, n) for d, p, s, n, _ in rows)
    assert len({r.sequence_id for r in out}) == 3
    assert packing.pack_documents(df.where("false"), 100).count() == 0


def test_held_out_rows_teach_nothing(spark):
    """Labels of held-out rows, however wrong, change no score."""
    docs = spark.read.parquet(f"{MID}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    wrong = labels.withColumn("toxic", F.when(toxic_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x, toxic_held_out) for x in (labels, wrong))
    assert a.weights == b.weights and all((x == y).all() for x, y in zip(a.knots, b.knots))
