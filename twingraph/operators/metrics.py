"""Traceability, precision / recall and graph-level counters.

Counters the reference keeps in mutable globals become aggregates; the ones
whose value depends on processing order become running sums in an explicit
order (original id), computed with the skew-safe two-level prefix sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scores as S
from .kernel import prefix_rank, prefix_sum


def _i(cond) -> F.Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _link_stats(atl, wtl, gtl, btl, rtl) -> dict[str, F.Column]:
    """ACC / VPR / BTLR from link totals, with the all-good / all-bad overrides."""
    atl, wtl, gtl, btl, rtl = (x.cast("double") for x in (atl, wtl, gtl, btl, rtl))
    vpr = (F.when((gtl == rtl) & (btl == 0), F.lit(1.0))
           .when((btl == rtl) & (gtl == 0), F.lit(0.0))
           .when(rtl != 0, (atl - wtl) / (rtl * F.lit(2.0)) + F.lit(0.5)))
    return {"acc": F.when(rtl != 0, atl / rtl), "vpr": vpr, "btlr": F.when(rtl != 0, wtl / rtl)}


def edge_traceability(edge_scores: DataFrame) -> DataFrame:
    """A1 + A2 per original source node over its edge scores."""
    s = F.col("score")
    agg = edge_scores.groupBy(F.col("src").alias("node")).agg(
        F.count_if(s >= C.EDGE_ACCEPT).alias("atl"),
        F.count_if(s >= C.EDGE_KEEP).alias("tp"),
        F.count_if(s < C.EDGE_KEEP).alias("wtl"),
        F.count_if(s > C.EDGE_ACCEPT).alias("above"),
        F.count_if(s == C.EDGE_ACCEPT).alias("even"),
        F.count_if(s > C.EDGE_CTL).alias("ctl"),
        F.count_if(s < C.EDGE_WTL).alias("wtl_links"),
        F.count_if(s < C.EDGE_DTL).alias("dtl"))
    gtl = F.col("dtl") + F.col("even") + F.col("above")
    btl = F.col("ctl") + F.col("wtl_links")
    st = _link_stats(F.col("atl"), F.col("wtl"), gtl, btl, gtl + btl)
    return agg.select(
        "node", *[F.col(c).cast("bigint").alias(c) for c in
                  ("atl", "tp", "wtl", "above", "even", "ctl", "wtl_links", "dtl")],
        gtl.cast("bigint").alias("gtl"), btl.cast("bigint").alias("btl"), (gtl + btl).cast("bigint").alias("rtl"),
        st["acc"].alias("acc"), st["vpr"].alias("vpr"), st["btlr"].alias("btlr"))


def _node_line_counts(score) -> dict[str, F.Column]:
    """A4 per scored line: even / CTL / WTL / DTL (``above`` is fixed at 0.9)."""
    return {
        "even": _i(score == C.NODE_EVEN),
        "ctl": _i(score > C.NODE_CTL),
        "wtl_links": _i(score < C.NODE_WTL),
        "dtl": _i(score < C.NODE_DTL),
    }


def node_traceability(scores: DataFrame) -> DataFrame:
    """A3 + A4 totals over scored node pairs (one row)."""
    s = F.col("score")
    lines = _node_line_counts(s)
    return scores.agg(
        F.count_if(s >= C.NODE_ACCEPT).cast("bigint").alias("atl"),
        F.count_if(s >= C.NODE_KEEP).cast("bigint").alias("tp"),
        F.count_if(s < C.NODE_KEEP).cast("bigint").alias("wtl"),
        F.count_if(s >= C.NODE_ACCEPT).cast("bigint").alias("fp"),
        *[F.sum(v).cast("bigint").alias(k) for k, v in lines.items()],
        F.count(F.lit(1)).cast("bigint").alias("pairs"),
    ).withColumn("precision", S.percent_clamped(F.col("tp"), F.col("tp") + F.col("fp")))


def node_traceability_running(scores: DataFrame) -> DataFrame:
    """A3 running form + A4/A5/A10 per line, in (original id, perturbed id) order."""
    s = F.col("score")
    base = scores.select("o_id", "p_id", "score", *[v.alias(k) for k, v in _node_line_counts(s).items()])
    run = prefix_sum(base, [], ["o_id", "p_id"], {
        "atl_run": _i(s >= C.NODE_ACCEPT), "tp_run": _i(s >= C.NODE_KEEP),
        "wtl_run": _i(s < C.NODE_KEEP)})
    run = run.withColumn("fp_run", F.col("atl_run"))
    atl_line = F.col("even").cast("double") + F.lit(C.NODE_ABOVE_OVERRIDE)
    gtl = F.col("dtl").cast("double") + atl_line
    btl = (F.col("ctl") + F.col("wtl_links")).cast("double")
    rtl = gtl + btl
    st = _link_stats(F.col("atl_run"), F.col("wtl_run"), gtl, btl, rtl)
    precision = S.percent_clamped(F.col("tp_run"), F.col("tp_run") + F.col("fp_run"))
    node = F.col("p_id").cast("string")
    verdict = (F.when(F.col("p_id").isNull(), F.lit("Node number not found or not a valid integer"))
               .when(precision > C.VERDICT_PRECISION,
                     F.concat(F.lit("Node "), node, F.lit(": has been successfully attacked")))
               .otherwise(F.concat(F.lit("Node "), node, F.lit(": was unsuccessfully attacked"))))
    return run.select(
        "o_id", "p_id", "score", "atl_run", "tp_run", "wtl_run", "fp_run",
        rtl.alias("rtl"), st["acc"].alias("acc"), st["vpr"].alias("vpr"), st["btlr"].alias("btlr"),
        precision.alias("precision"),
        F.when(F.col("tp_run") > 0, F.lit(100.0)).alias("recall"),
        verdict.alias("verdict"))


def graph_counter_rows(strict: DataFrame, discarded: DataFrame) -> DataFrame:
    """A11 contributions per original node (re-aimed to same-id pairs).

    ``strict``: (o_id, p_id, pts, score) with p_id NULL for removed nodes;
    ``discarded``: ids of original nodes absent from P by value, scored
    against their same-id counterpart (0 when removed).
    """
    d = discarded.withColumn("_disc", F.lit(True))
    j = strict.join(d, strict["o_id"] == d["d_id"], "left")
    s = F.col("score")
    disc = F.coalesce("_disc", F.lit(False))
    ds = F.coalesce(s, F.lit(0.0))
    return j.select(
        "o_id", "p_id", s.alias("score"),
        _i(s >= C.GRAPH_ACCEPT).alias("atl"),
        _i(s < C.GRAPH_WRONG).alias("wtl"),
        _i(disc & (ds >= C.GRAPH_DISCARD_CTL)).alias("ctl"),
        _i(disc & (ds < C.GRAPH_DISCARD_NONE)).alias("dtl"))


def graph_counters(rows: DataFrame, triangular: bool = False) -> DataFrame:
    """A11 totals: ATL = TP, WTL = FP, CTL = FN, DTL; TN stays 0.

    ``triangular`` counts the k-th original (in id order) k times, as a pass over the remaining originals
    after each one does.
    """
    times = F.lit(1)
    if triangular:
        rows, times = prefix_rank(rows, [], ["o_id", "p_id"], out="_k"), F.col("_k") + 1
    total = lambda c: F.sum(F.col(c) * times).cast("bigint")
    return rows.agg(
        total("atl").alias("atl"), total("atl").alias("tp"), total("wtl").alias("wtl"), total("wtl").alias("fp"),
        total("ctl").alias("ctl"), total("ctl").alias("fn"), total("dtl").alias("dtl"), F.lit(0).cast("bigint").alias("tn"))


def precision_recall(counters: DataFrame) -> DataFrame:
    """A5 (noise free): precision and recall in %, clamped to [0, 100]."""
    return counters.select(
        "tp", "fp", "fn",
        S.percent_clamped(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        S.percent_clamped(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def f1_table(counters: DataFrame) -> DataFrame:
    """A6 + A7."""
    return counters.select("tp", "fp", "fn", "tn",
                           S.f1("tp", "fp", "fn").alias("f1"), S.specificity("tn", "fp").alias("specificity"))


def pair_report(rows: DataFrame) -> DataFrame:
    """Per original (id order) the cumulative counters and link ratios."""
    run = prefix_sum(rows, [], ["o_id"], {"c_atl": "atl", "c_wtl": "wtl", "c_ctl": "ctl", "c_dtl": "dtl"})
    gtl = F.col("c_dtl") + F.col("c_atl")
    btl = F.col("c_ctl") + F.col("c_wtl")
    rtl = gtl + btl
    st = _link_stats(F.col("c_atl"), F.col("c_wtl"), gtl, btl, rtl)
    tp, fp, fn = F.col("c_atl").cast("double"), F.col("c_wtl").cast("double"), F.col("c_ctl").cast("double")
    return run.select(
        "o_id", "p_id", F.col("score").alias("similarity"),
        F.col("c_atl").cast("bigint").alias("atl"), F.col("c_ctl").cast("bigint").alias("ctl"),
        F.col("c_dtl").cast("bigint").alias("dtl"), F.col("c_wtl").cast("bigint").alias("wtl"),
        rtl.cast("bigint").alias("rtl"), st["acc"].alias("acc"), st["vpr"].alias("vpr"), st["btlr"].alias("btlr"),
        F.when(tp + fp != 0, tp / (tp + fp) * F.lit(100.0)).alias("precision"),
        F.when(tp + fn != 0, tp / (tp + fn) * F.lit(100.0)).alias("recall"))


def score_text(running: DataFrame) -> DataFrame:
    """The text block printed per scored pair (verdict, precision, recall, F1)."""
    f1 = S.f1(F.col("tp_run"), F.col("fp_run"), F.lit(0))

    def txt(c):
        return F.coalesce(c.cast("string"), F.lit("NaN"))

    return running.select(
        "o_id", "p_id",
        F.concat(F.col("verdict"), F.lit(" \nPrecision: "), txt(F.col("precision")),
                 F.lit("\nRecall: "), txt(F.col("recall")), F.lit("\nF1-Score: "), txt(f1)).alias("text"))
