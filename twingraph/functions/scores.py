"""Column expressions for node / edge similarity.

All scores are integer points divided by a constant, so they are exact and
identical on any engine; two-decimal rounding is ``bround`` (half-even),
which never meets a tie for points / 81.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def tolerance(base_pct: float, modifier: float = C.TOLERANCE_MODIFIER) -> float:
    """Relative tolerance as a fraction, computed like the reference: (base*(1+m))/100."""
    return (base_pct * (1 + modifier)) / 100.0


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def tolerant_match(o, p, frac: float) -> Column:
    """|o - p| <= o * frac (asymmetric; o = 0 only matches p = 0)."""
    return F.abs(_d(o) - _d(p)) <= _d(o) * F.lit(frac)


def both_true(o, p) -> Column:
    """A match only when both flags are true."""
    o = F.col(o) if isinstance(o, str) else o
    p = F.col(p) if isinstance(p, str) else p
    return F.coalesce(o & p, F.lit(False))


def tolerant_matches(o_prefix: str = "o_", p_prefix: str = "p_") -> dict[str, Column]:
    m = {name: tolerant_match(f"{o_prefix}{name}", f"{p_prefix}{name}", tolerance(base))
         for name, base, _ in C.TOLERANT_PROPS}
    m["valuable_data"] = both_true(f"{o_prefix}valuable_data", f"{p_prefix}valuable_data")
    return m


def tolerant_points(o_prefix: str = "o_", p_prefix: str = "p_") -> Column:
    """X3 points (0-90) of the tolerant node score."""
    m = tolerant_matches(o_prefix, p_prefix)
    pts = [F.when(m[name], F.lit(w)).otherwise(F.lit(0)) for name, _, w in C.TOLERANT_PROPS]
    pts.append(F.when(m["valuable_data"], F.lit(C.VALUABLE_POINTS)).otherwise(F.lit(0)))
    total = pts[0]
    for x in pts[1:]:
        total = total + x
    return total.cast("bigint")


def changed_count(o_prefix: str = "o_", p_prefix: str = "p_") -> Column:
    """Number of the 9 properties that do not match (0-9)."""
    total = F.lit(0)
    for c in tolerant_matches(o_prefix, p_prefix).values():
        total = total + F.when(c, F.lit(0)).otherwise(F.lit(1))
    return total.cast("bigint")


def points_score(pts) -> Column:
    """Score from points: (pts/90)/0.9 = pts/81, 0 when no point."""
    pts = F.col(pts) if isinstance(pts, str) else pts
    return (F.when(pts > 0, pts.cast("double") / F.lit(float(C.SCORE_DIVISOR)))
            .when(pts.isNotNull(), F.lit(0.0)))


def rounded(score) -> Column:
    """P10: two decimals, half-even."""
    score = F.col(score) if isinstance(score, str) else score
    return F.bround(score, 2)


def strict_points(o_prefix: str = "o_", p_prefix: str = "p_", invert_ratio: bool = True) -> Column:
    """X7 points: exact equality plus the stored-value ratio rule.

    With ``invert_ratio`` (the reference's behaviour) the stored value counts
    as matching when o/p > 1.56, or p = 0 (the ratio is then infinite or NaN).
    """
    total = F.lit(0)
    for name, w in C.STRICT_PROPS:
        total = total + F.when(F.col(f"{o_prefix}{name}") == F.col(f"{p_prefix}{name}"), F.lit(w)).otherwise(0)
    o, p = _d(f"{o_prefix}stored_value"), _d(f"{p_prefix}stored_value")
    ratio_small = F.when(p == 0, F.lit(False)).otherwise(o / p <= F.lit(C.STRICT_STORED_VALUE_RATIO))
    sv_match = ~ratio_small if invert_ratio else ratio_small
    total = total + F.when(sv_match, F.lit(C.STRICT_STORED_VALUE_POINTS)).otherwise(0)
    return total.cast("bigint")


def equality_jaccard(o_prefix: str = "o_", p_prefix: str = "p_") -> Column:
    """Share of the 8 numeric properties that are exactly equal."""
    total = F.lit(0)
    for name, _, _ in C.TOLERANT_PROPS:
        total = total + F.when(F.col(f"{o_prefix}{name}") == F.col(f"{p_prefix}{name}"), 1).otherwise(0)
    return total.cast("double") / F.lit(8.0)


def edge_score(o_weight, p_weight) -> Column:
    """1.11 when the perturbed weight is within 5.75 % of the original, else 0."""
    return (F.when(tolerant_match(o_weight, p_weight, C.EDGE_WEIGHT_TOLERANCE / 100.0),
                   F.lit(C.EDGE_MATCH_SCORE)).otherwise(F.lit(0.0)))


def f1(tp, fp, fn) -> Column:
    """F1 from counts; NULL when precision or recall is undefined (0/0)."""
    tp, fp, fn = (_d(x) for x in (tp, fp, fn))
    prec = F.when(tp + fp != 0, tp / (tp + fp))
    rec = F.when(tp + fn != 0, tp / (tp + fn))
    return F.when(prec + rec == 0, F.lit(0.0)).otherwise(F.lit(2.0) * (prec * rec) / (prec + rec))


def specificity(tn, fp) -> Column:
    """Tn / (tn + fp); NULL on 0/0."""
    tn, fp = _d(tn), _d(fp)
    return F.when(tn + fp != 0, tn / (tn + fp))


def percent_clamped(num, den) -> Column:
    """A5 (noise free): 100 * num / den clamped to [0, 100]; NULL when den = 0."""
    num, den = _d(num), _d(den)
    return F.when(den != 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), num / den * F.lit(100.0))))


def jitter(score, a, b, seed: int, amount: float = 0.1) -> Column:
    """X11: add a seeded offset in [-amount, amount) (the reference adds +-0.1 noise).

    Off unless called; the registered queries keep scores exact.
    """
    from .hashing import draw
    score = F.col(score) if isinstance(score, str) else score
    return score + draw(a, b, seed) * F.lit(2 * amount) - F.lit(amount)
