"""Isotonic calibration of a raw score from grouped counts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 2000


def pool_adjacent(ones: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of the shares ``ones / rows`` (pool adjacent violators)."""
    stack: list[list[float]] = []  # ones, rows, bins
    for a, b in zip(ones.tolist(), rows.tolist()):
        stack.append([a, b, 1])
        while len(stack) > 1 and stack[-2][0] * stack[-1][1] >= stack[-1][0] * stack[-2][1]:
            a1, b1, c1 = stack.pop()
            stack[-1] = [stack[-1][0] + a1, stack[-1][1] + b1, stack[-1][2] + c1]
    return np.concatenate([np.full(int(c), a / b) for a, b, c in stack]) if stack else np.zeros(0)


def fit_isotonic(scored: DataFrame, raw: str, label: str, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots ``(raw, probability)`` from rows with a raw score and a 0/1 label.

    The rows are counted in at most ``BINS`` bins between ``low`` and ``high`` on the
    executors; only the counts come to the driver. Half a row of either label at
    each end keeps probabilities off 0 and 1.
    """
    step = max(high - low, 1e-12) / BINS
    where = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((F.col(raw) - low) / step))).cast("int")
    counts = (scored.where(F.col(label).isin(0, 1)).groupBy(where.alias("bin"))
              .agg(F.sum(label).alias("ones"), F.count(F.lit(1)).alias("rows"), F.avg(raw).alias("at"))
              .orderBy("bin").collect())
    if not counts:
        return np.array([0.0]), np.array([0.5])
    at = np.array([r["at"] for r in counts])
    ones, rows = np.array([float(r["ones"]) for r in counts]), np.array([float(r["rows"]) for r in counts])
    ones = np.concatenate(([0.0], ones, [0.5]))
    rows = np.concatenate(([0.5], rows, [0.5]))
    fit = pool_adjacent(ones, rows)
    return np.concatenate(([at[0] - step], at, [at[-1] + step])), np.clip(fit, 0.0, 1.0)


def apply_isotonic(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.clip(np.interp(raw, knots[0], knots[1]), 0.0, 1.0)
