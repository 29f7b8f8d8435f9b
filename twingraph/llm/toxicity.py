"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other alphabets to Latin and
digits or signs inside words to the letters that they replace; everything that is
no letter becomes one blank. Lexicon entries are whole words and word beginnings.
Their weights (log odds) are learned from labelled rows; a hit inside an exception
phrase does not count. The raw score is the weight of the hits over the length;
an isotonic fit on the same labelled rows turns it into a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calibration import fit_isotonic
from .common import materialise, small_batches, with_text

MAX_LABELLED = 40_000   # labelled rows that the lexicon is learned from, at most
MAX_TERMS = 5_000
COUNTED_AT_ONCE = 200_000  # terms that a task counts before it passes the counts on
PREFIX = range(3, 11)
MIN_SUPPORT = 4         # toxic texts that a term must stand in
MIN_PRECISION = 0.6     # lower confidence bound of a term's share of toxic texts

# Letters that look like Latin ones (Cyrillic, Greek), and signs read as letters.
LOOK_ALIKES = dict(zip("авеёіјкмнорстухѕԁԛԝαβεικνορτυχ", "abeeijkmhopctyxsdqwabeiknoptux"))
SIGNS = dict(zip("013457@$!|", "oieastasii"))
EXCEPTIONS = ("trash can", "trash bin", "class clown fish", "idiot proof", "clown fish", "scum line", "sore loser bracket")

_LOOK = str.maketrans(LOOK_ALIKES)
_SIGN = str.maketrans(SIGNS)
_BEFORE_LETTER = re.compile(r"[013457@$!|]+(?=[^\W\d_])")
_AFTER_LETTER = re.compile(r"(?<=[^\W\d_])[013457]+")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Folded words of a text, each after one blank, with a blank at the end."""
    t = (text or "").lower().translate(_LOOK)
    t = _BEFORE_LETTER.sub(lambda m: m[0].translate(_SIGN), t)
    t = _AFTER_LETTER.sub(lambda m: m[0].translate(_SIGN), t)
    return f" {_NOT_LETTERS.sub(' ', t).strip()} "


def text_terms(text: str | None) -> set[str]:
    """Whole words (blank at both ends) and word beginnings (blank before) of a text."""
    words = set(fold(text).split())
    out = {f" {w} " for w in words}
    for w in words:
        out.update(f" {w[:k]}" for k in PREFIX if k < len(w))
    return out


class Matcher:
    """Aho-Corasick automaton over lexicon entries and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...]):
        self.found = ahocorasick.Automaton()
        for term, w in weights.items():
            self.found.add_word(term, (len(term), w, False))
        for phrase in exceptions:
            if fold(phrase).strip():
                self.found.add_word(fold(phrase), (len(fold(phrase)), 0.0, True))
        if len(self.found):
            self.found.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight): one hit, the heaviest, for each word outside exceptions."""
        if not len(self.found):
            return []
        spared, best = [], {}
        for end, (size, weight, is_exception) in self.found.iter(folded):
            start = end - size + 1
            if is_exception:
                spared.append((start, end))
            elif start not in best or weight > best[start][2]:
                best[start] = (start, end, weight)
        return [h for h in best.values() if not any(a <= h[0] and h[1] <= b for a, b in spared)]

    def raw(self, text: str | None) -> float:
        """Sum of the weights of the hits by the root of the number of words."""
        folded = fold(text)
        total = sum(w for _, _, w in self.hits(folded))
        return total / np.sqrt(max(folded.count(" ") - 1, 1)) if total else 0.0


def _low(t, c, root):
    """Lower confidence bound of the share of toxic texts, of numbers or columns."""
    n, z = t + c, 1.64
    share = t / n
    return (share + z * z / (2 * n) - z * root(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Weights of the terms that mark toxic texts; ``texts`` has ``text`` and ``toxic`` (0/1).

    Equal texts count once. Terms are counted in toxic and clean texts, and those that
    stand in enough toxic ones with a high share of them are collected. Of beginnings with one count the longest stands for
    all; a longer one is dropped where a shorter one that is kept already marks it.
    """
    once = texts.groupBy("text").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in once.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for big in batches:
            for b in small_batches(big, "text", 1 << 20):
                for t, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                    for term in text_terms(t):
                        seen.setdefault(term, [0, 0])[label] += 1
                if len(seen) > COUNTED_AT_ONCE:
                    yield counts(seen)
                    seen = {}
        yield counts(seen)

    def counts(seen: dict[str, list[int]]) -> pa.RecordBatch:
        clean, toxic = ([v[k] for v in seen.values()] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())],
                                          names=["term", "t", "c"])

    found = once.select("text", "toxic").mapInArrow(counted, "term string, t long, c long")
    found = found.groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") >= MIN_SUPPORT)
    # What marks a longer beginning as good as a shorter one has its toxic count and no more clean ones: it passes with it.
    rows = found.where(_low(F.col("t"), F.col("c"), F.sqrt) >= MIN_PRECISION - 1e-9).collect()
    hits, clean = {r["term"]: r["t"] for r in rows}, {r["term"]: r["c"] for r in rows}
    longer = {}  # the largest count among the entries that go on from a beginning
    for term, n in hits.items():
        word = term.strip()
        for k in (k for k in PREFIX if k < len(word) or k == len(word) and term.endswith(" ")):
            longer[f" {word[:k]}"] = max(longer.get(f" {word[:k]}", 0), n)
    weights: dict[str, float] = {}
    for term in sorted(hits, key=lambda t: (len(t.rstrip()) + t.endswith(" "), t)):
        t, c = hits[term], clean[term]
        if _low(t, c, np.sqrt) < MIN_PRECISION or longer.get(term, 0) == t:
            continue
        word = term.strip()
        if any(f" {word[:k]}" in weights for k in PREFIX if k <= len(word) and f" {word[:k]}" != term):
            continue
        odds = np.log((t + 0.5) / (sizes[1] + 1)) - np.log((c + 0.5) / (sizes[0] + 1))
        weights[term] = float(odds)
    top = sorted(weights, key=lambda t: (-weights[t], t))[:MAX_TERMS]
    return {t: weights[t] for t in top}


def raw_scores(df: DataFrame, weights: dict[str, float], exceptions: tuple[str, ...], keep: list[str], text: str) -> DataFrame:
    """``keep`` columns and ``raw``; the lexicon has at most ``MAX_TERMS`` entries."""
    lexicon = df.sparkSession.sparkContext.broadcast((weights, exceptions))
    source, column = with_text(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*lexicon.value)
        for big in batches:
            for b in small_batches(big, column):
                raw = [matcher.raw(t) for t in b.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(raw, pa.float64())], names=[*keep, "raw"])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{fields}, raw double")


def labelled(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, held_out, limit: int) -> DataFrame:
    """``doc_id, text`` and the label of training rows, at most about ``limit`` of them, chosen by a hash of the id.

    The chosen labels are so few whatever the size of the tables that they are broadcast.
    """
    known = labels.where(F.col(label).isin(0, 1)).where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    n = known.count()
    share = min(1.0, limit / max(n, 1))
    known = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000))
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text")).join(F.broadcast(known), "doc_id")


class ToxicityModel:
    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...], knots):
        self.weights, self.exceptions, self.knots = weights, exceptions, knots

    def score(self, df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """``keep`` columns, ``score`` (0 to 1) and ``predicted`` of every row; null text counts as empty."""
        raw = raw_scores(df, self.weights, self.exceptions, keep, text)
        knots = list(zip(*(k.tolist() for k in self.knots)))
        score = F.lit(knots[-1][1])
        # linear between knots, as a chain of conditions over the bounded list of levels
        for (x0, y0), (x1, y1) in reversed(list(zip(knots, knots[1:]))):
            score = F.when(F.col("raw") < x1, F.lit(y0) + (F.col("raw") - x0) / (x1 - x0) * (y1 - y0)).otherwise(score)
        score = F.when(F.col("raw") <= knots[0][0], F.lit(knots[0][1])).otherwise(score) if len(knots) > 1 else score
        return raw.select(*keep, score.cast("double").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _levels(knots: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The knots where the fit bends; the others lie on lines between them."""
    x, y = knots
    if len(x) < 3:
        return x, y
    bend = np.concatenate(([True], (y[1:-1] != y[:-2]) | (y[1:-1] != y[2:]), [True]))
    return x[bend], y[bend]


def fit(docs: DataFrame, labels: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text",
        exceptions: tuple[str, ...] = EXCEPTIONS, limit: int = MAX_LABELLED) -> ToxicityModel:
    """Learn the lexicon and the calibration from labelled rows that are not held out.

    ``held_out`` maps an id column to a condition. Only ``toxic`` labels 0 and 1 count.
    Without labels of both kinds the lexicon is empty and every score is the share of
    toxic labels (0.0 without any label).
    """
    train, _ = materialise(labelled(docs, labels, "toxic", doc_id, text, held_out, limit), "toxic-labelled")
    weights = learn_lexicon(train)
    if not weights:
        share = train.agg(F.avg("toxic")).first()[0] or 0.0
        return ToxicityModel({}, exceptions, (np.array([0.0]), np.array([float(share)])))
    scored, _ = materialise(raw_scores(train, weights, exceptions, ["toxic"], "text"), "toxic-scored")
    high = scored.agg(F.max("raw")).first()[0] or 0.0
    return ToxicityModel(weights, exceptions, _levels(fit_isotonic(scored, "raw", "toxic", 0.0, high)))
