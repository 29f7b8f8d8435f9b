"""Scalar rules against their formulas."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from twingraph.functions import scores as S


def _one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values())], list(cols.keys())).select(expr.alias("v")).first()
    return row["v"]


@pytest.mark.parametrize("tp,fp,fn", [(3, 1, 2), (7, 0, 4), (1, 99, 0), (12, 5, 31), (640, 17, 3), (1, 0, 0)])
def test_f1(spark, tp, fp, fn):
    want = Fraction(2 * tp, 2 * tp + fp + fn)  # harmonic mean of tp / (tp + fp) and tp / (tp + fn)
    assert _one(spark, S.f1("tp", "fp", "fn"), tp=tp, fp=fp, fn=fn) == pytest.approx(float(want), abs=1e-15)


def test_f1_undefined_is_null(spark):
    assert _one(spark, S.f1("tp", "fp", "fn"), tp=0, fp=0, fn=0) is None
    assert _one(spark, S.f1("tp", "fp", "fn"), tp=0, fp=3, fn=4) == 0.0


@pytest.mark.parametrize("tn,fp", [(3, 4), (11, 0), (0, 6), (250, 1)])
def test_specificity(spark, tn, fp):
    assert _one(spark, S.specificity("tn", "fp"), tn=tn, fp=fp) == pytest.approx(tn / (tn + fp))


def test_edge_score(spark):
    assert _one(spark, S.edge_score("o", "p"), o=0.75, p=0.85) == 0.0
    assert _one(spark, S.edge_score("o", "p"), o=4.0, p=4.0) == 1.11


@pytest.mark.parametrize("a,b,v", [(10, 10, 1), (10, 12, 0)])
def test_equality(spark, a, b, v):
    assert _one(spark, F.when(F.col("a") == F.col("b"), 1).otherwise(0), a=a, b=b) == v


def test_tolerant_match_is_asymmetric(spark):
    frac = S.tolerance(10.0)  # 12 %
    assert _one(spark, S.tolerant_match("o", "p", frac), o=100.0, p=112.0) is True
    assert _one(spark, S.tolerant_match("o", "p", frac), o=112.0, p=100.0) is True
    assert _one(spark, S.tolerant_match("o", "p", frac), o=100.0, p=113.0) is False
    assert _one(spark, S.tolerant_match("o", "p", frac), o=0.0, p=0.0) is True
    assert _one(spark, S.tolerant_match("o", "p", frac), o=0.0, p=1.0) is False


def test_both_true(spark):
    assert _one(spark, S.both_true("o", "p"), o=True, p=True) is True
    assert _one(spark, S.both_true("o", "p"), o=False, p=False) is False


def _node(prefix, **kv):
    base = dict(id=1, children=2, props=10, current_depth=1, prop_value_range=50, max_depth=3,
                max_branching_factor=4, max_properties=8, stored_value=0.5, valuable_data=True)
    base.update(kv)
    return {f"{prefix}{k}": v for k, v in base.items()}


def test_tolerant_points_full_and_score(spark):
    cols = {**_node("o_"), **_node("p_")}
    assert _one(spark, S.tolerant_points(), **cols) == 90
    assert _one(spark, S.rounded(S.points_score(S.tolerant_points())), **cols) == 1.11
    cols = {**_node("o_"), **_node("p_", valuable_data=False, props=19)}
    assert _one(spark, S.tolerant_points(), **cols) == 55
    assert _one(spark, S.changed_count(), **cols) == 2


def test_strict_points_ratio_rule(spark):
    # o/p = 1 <= 1.56 counts as *changed* (the reference's inverted test)
    same = {**_node("o_"), **_node("p_")}
    assert _one(spark, S.strict_points(), **same) == 90 - 17
    # p = 0: ratio infinite -> match
    zero = {**_node("o_"), **_node("p_", stored_value=0.0)}
    assert _one(spark, S.strict_points(), **zero) == 90
    assert _one(spark, S.strict_points(invert_ratio=False), **same) == 90
