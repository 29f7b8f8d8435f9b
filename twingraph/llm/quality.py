"""Quality classifier: random Fourier features over document statistics.

A pass over the texts counts document statistics. Random Fourier features of the
standardised statistics approximate a Gaussian kernel; every partition sums its
share of the ridge normal equations, the sums are added up in blocks, and the
system of fixed size is solved on the driver. An isotonic fit on rows kept apart
turns the ridge score into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calibration import apply_isotonic, fit_isotonic
from .common import materialise, small_batches, utf8, with_text
from .toxicity import MAX_LABELLED, labelled

FEATURES = 384       # random Fourier features
WIDTH = 4.0          # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3         # per training row
SEED = 1_009
SIGNS = "#%$&*|!?.,;:()[]{}<>/\\@=+-_\"'~^`"  # counted one by one

_KINDS = np.zeros(256, np.uint8)  # class of a byte
_KINDS[[c for c in range(97, 123)]] = 1
_KINDS[[c for c in range(65, 91)]] = 2
_KINDS[[c for c in range(48, 58)]] = 3
_KINDS[[32, 9, 11, 12, 13]] = 4
_KINDS[10] = 5
_KINDS[128:] = 6
for _n, _c in enumerate(SIGNS):
    _KINDS[ord(_c)] = 7 + _n
N_KINDS = 7 + len(SIGNS)

WORD_STATS = ("mean_word", "sd_word", "short_words", "long_words", "upper_words", "signed_words", "last_sign_words",
              "mean_line", "sd_line", "short_lines", "log_bytes", "log_words", "runs", "same_words")
STATISTICS = [f"kind_{i}" for i in range(N_KINDS)] + list(WORD_STATS)


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the offsets of each row (an empty row: 0)."""
    run = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return run[off[1:]] - run[off[:-1]]


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One line of ``STATISTICS`` for each text, from its bytes alone."""
    n, size = len(off) - 1, np.diff(off)
    row = np.repeat(np.arange(n), size)
    kind = _KINDS[data]
    counts = np.bincount(row * N_KINDS + kind, minlength=n * N_KINDS).reshape(n, N_KINDS).astype(np.float64)
    share = counts / np.maximum(size, 1)[:, None]

    def pieces(gap: np.ndarray):
        """(row, first, end) of the runs without gap bytes; runs end with their text."""
        inside = ~gap
        first = inside.copy()
        first[1:] &= gap[:-1] | (row[1:] != row[:-1])
        last = inside.copy()
        last[:-1] &= gap[1:] | (row[1:] != row[:-1])
        a, z = np.flatnonzero(first), np.flatnonzero(last) + 1
        return row[a], a, z

    def mean_sd(of: np.ndarray, lens: np.ndarray):
        k = np.maximum(np.bincount(of, minlength=n), 1)
        mean = np.bincount(of, lens, n) / k
        return mean, np.sqrt(np.maximum(np.bincount(of, lens.astype(np.float64) ** 2, n) / k - mean ** 2, 0)), k

    if not len(data):
        return np.zeros((n, len(STATISTICS)))
    w_row, a, z = pieces((kind == 4) | (kind == 5))
    lens = (z - a).astype(np.float64)
    mean_w, sd_w, words = mean_sd(w_row, lens)
    portion = lambda mask: np.bincount(w_row, mask, n) / words
    sign_run = np.concatenate(([0], np.cumsum(kind >= 7)))
    upper_run = np.concatenate(([0], np.cumsum(kind == 2)))
    signs, uppers = sign_run[z] - sign_run[a], upper_run[z] - upper_run[a]
    l_row, la, lz = pieces(kind == 5)
    line_lens = np.log1p((lz - la).astype(np.float64))
    mean_l, sd_l, lines = mean_sd(l_row, line_lens)
    repeats = np.zeros(len(data), bool)
    repeats[1:] = (data[1:] == data[:-1]) & (row[1:] == row[:-1])
    # A word that repeats the one before it: same length, same sum and same sum of squares of its bytes.
    wide = data.astype(np.int64)
    run1, run2 = np.concatenate(([0], np.cumsum(wide))), np.concatenate(([0], np.cumsum(wide * wide)))
    sign = np.column_stack((w_row, z - a, run1[z] - run1[a], run2[z] - run2[a]))
    same = np.zeros(len(a), bool)
    same[1:] = (sign[1:] == sign[:-1]).all(axis=1)
    more = np.column_stack([
        np.log1p(mean_w), np.log1p(sd_w), portion(lens <= 2), portion(lens >= 14), portion((uppers == lens) & (lens > 1)),
        portion(signs > 0), portion(_KINDS[data[z - 1]] >= 7), mean_l, sd_l,
        np.bincount(l_row, line_lens < np.log1p(20), n) / lines, np.log1p(size), np.log1p(np.bincount(w_row, minlength=n)),
        _per_row(repeats, off) / np.maximum(size, 1), portion(same)])
    return np.hstack((np.sqrt(share), more))


def _texts_to(df: DataFrame, keep: list[str], text: str, name: str, kind: str, made) -> DataFrame:
    """``keep`` columns and ``name``, which ``made`` computes from the statistics of the texts."""
    source, column = with_text(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in small_batches(big, column, 2 << 20):
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), made(statistics(*utf8(b.column(column))))], names=[*keep, name])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return source.mapInArrow(run, f"{fields}, `{name}` {kind}")


def document_statistics(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``stats`` (in the order of ``STATISTICS``) of every row; null text counts as empty."""
    width = len(STATISTICS)

    def lists(m: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, width, dtype=np.int32)), pa.array(m.ravel().astype(np.float32)))

    return _texts_to(df, keep, text, "stats", "array<float>", lists)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


class QualityModel:
    def __init__(self, mean, sd, weights, knots):
        self.mean, self.sd, self.weights, self.knots = mean, sd, weights, knots

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.standard_normal((len(STATISTICS), FEATURES)) / WIDTH
        z = np.sqrt(2.0 / FEATURES) * np.cos(np.clip((stats - self.mean) / self.sd, -8, 8) @ w + rng.uniform(0, 2 * np.pi, FEATURES))
        return np.hstack((z, np.ones((len(stats), 1))))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def raw_scores(self, stats_df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns and ``raw`` of a table with ``stats``."""
        model = stats_df.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for big in batches:
                for at in range(0, big.num_rows, 4096):
                    b = big.slice(at, 4096)
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(model.value.raw(_matrix(b.column("stats"))))],
                                                     names=[*keep, "raw"])

        fields = ", ".join(f"`{c}` {stats_df.schema[c].dataType.simpleString()}" for c in keep)
        return stats_df.select(*keep, "stats").mapInArrow(run, f"{fields}, raw double")

    def score(self, df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """``keep`` columns, ``score`` (0 to 1) and ``predicted`` of every row; null text counts as empty."""
        model = df.sparkSession.sparkContext.broadcast(self)

        def probabilities(stats: np.ndarray) -> pa.Array:
            return pa.array(apply_isotonic(model.value.raw(stats.astype(np.float32).astype(np.float64)), model.value.knots), pa.float64())

        return _texts_to(df, keep, text, "score", "double", probabilities).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _normal_equations(train: DataFrame, model: QualityModel, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all rows: by partition, then added by matrix line on the executors."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        some = False
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                z = shared.value.features(_matrix(part.column("stats")))
                y = part.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
                total += np.hstack((z.T @ z, z.T @ y[:, None]))
                some = some or part.num_rows > 0
        if some:
            lines = pa.ListArray.from_arrays(pa.array(np.arange(0, total.size + 1, FEATURES + 2, dtype=np.int32)), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), lines], names=["line", "sums"])

    sums = train.select("stats", label).mapInArrow(partial, "line long, sums array<double>")
    table = np.array([r["sums"] for r in _sum_lines(sums).orderBy("line").collect()])
    return (table[:, :-1], table[:, -1]) if len(table) else (np.eye(FEATURES + 1), np.zeros(FEATURES + 1))


def _sum_lines(sums: DataFrame) -> DataFrame:
    """Element-wise sum of the arrays of each line, as a plain grouped sum of elements."""
    flat = sums.select("line", F.posexplode("sums").alias("col", "value"))
    return (flat.groupBy("line", "col").agg(F.sum("value").alias("value"))
            .groupBy("line").agg(F.transform(F.sort_array(F.collect_list(F.struct("col", "value"))), lambda x: x["value"]).alias("sums")))


def fit(docs: DataFrame, labels: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        limit: int = MAX_LABELLED) -> QualityModel:
    """Fit on labelled rows that are not held out, at most about ``limit`` of them (chosen by a hash of the id).

    One in five of them calibrates, the others fit the ridge. Only labels 0 and 1
    count; with labels of one kind only the score is that label's share, and without
    any it is 1.0, so that nothing is rejected unjudged.
    """
    rows = document_statistics(labelled(docs, labels, label, doc_id, text, held_out, limit), ["doc_id", label])
    train, _ = materialise(rows.withColumn("part", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(29)), F.lit(5))), "quality-labelled")
    width = len(STATISTICS)
    seen = train.agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("share"),
                     *[F.avg(F.get("stats", F.lit(i))).alias(f"m{i}") for i in range(width)],
                     *[F.stddev_pop(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
    if not seen["n"] or seen["share"] in (0.0, 1.0):
        share = seen["share"] if seen["n"] else 1.0
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(FEATURES + 1), (np.array([0.0]), np.array([float(share)])))
    mean = np.array([seen[f"m{i}"] for i in range(width)])
    sd = np.array([seen[f"s{i}"] for i in range(width)])
    model = QualityModel(mean, np.where(sd > 1e-9, sd, 1.0), None, None)
    gram, right = _normal_equations(train.where("part > 0"), model, label)
    rows_fit = max(float(gram[-1, -1]), 1.0)
    model.weights = np.linalg.solve(gram + RIDGE * rows_fit / FEATURES * np.eye(FEATURES + 1), right)
    apart = model.raw_scores(train.where("part = 0"), [label])
    apart, _ = materialise(apart, "quality-scored")
    model.knots = fit_isotonic(apart, "raw", label, -0.5, 1.5)
    return model
