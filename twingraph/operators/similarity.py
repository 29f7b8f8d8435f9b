"""Node / edge pairing and similarity scoring.

Pairs are never produced as a cross product. ``pairs_by_id`` is the natural
pairing of a node with its own counterpart; ``candidate_pairs`` is an exact
threshold join: every (original, perturbed) pair whose tolerant score reaches
``min_points`` is found through equi-joins only, and nothing else needs a
recheck beyond the candidates.

Candidate generation (prefix-filter idea from set-similarity joins, applied
to weighted properties): to reach ``need`` points out of the ``avail``
points still open, a pair may miss at most ``avail - need``; so it must
match at least one property of any group whose weights sum to more than
that. Splitting on the members of the smallest such group, ordered by
weight, and excluding earlier members in later branches, partitions the
qualifying pairs into disjoint branches, so no ``distinct`` is needed. A
branch is an equi-join on buckets of its matched properties: a value is its own
bucket while small and falls into a logarithmic one beyond, so a tolerance range
covers a few buckets however large the values. Each side is read once: a row is
exploded into the keys of all branches.

Equal nodes are joined once: :func:`profiles` keeps one row per distinct property
tuple, with its smallest id and its count, and results are expanded afterwards.

The best matches need no pairs of nodes at all: :func:`_first_matches` joins cells,
the distinct values of all properties but the stored value, whose number the ranges of
the small properties bound, and reads stored values by narrow buckets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scores as S
from ..schemas import NODE_FIELDS, NODE_PROPS
from .kernel import HOT, cut_lineage, prefix_rank, prefix_sum


def prefixed(nodes: DataFrame, prefix: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(f"{prefix}{c}") for c in NODE_FIELDS])


def pairs_by_id(o_nodes: DataFrame, p_nodes: DataFrame, how: str = "inner") -> DataFrame:
    """J1 (re-aimed): each original node with the perturbed node of the same id."""
    o, p = prefixed(o_nodes, "o_"), prefixed(p_nodes, "p_")
    return o.join(p, o["o_id"] == p["p_id"], how)


def node_scores(pairs: DataFrame) -> DataFrame:
    """X3-X5 on a PAIR frame: points, changed count, rounded score, authentic flag."""
    pts = S.tolerant_points()
    return pairs.select(
        "o_id", "p_id",
        pts.alias("pts"),
        S.changed_count().alias("changed"),
        S.rounded(S.points_score(pts)).alias("score"),
        (pts >= C.BEST_MATCH_MIN_POINTS).alias("authentic"))


def strict_scores(pairs: DataFrame, invert_ratio: bool = True) -> DataFrame:
    """X7 on a PAIR frame: strict points and the unrounded score."""
    pts = F.when(F.col("p_id").isNotNull(), S.strict_points(invert_ratio=invert_ratio))
    return pairs.select("o_id", "p_id", pts.alias("pts"), S.points_score(pts).alias("score"))


def jaccard_scores(pairs: DataFrame) -> DataFrame:
    """X8 on a PAIR frame."""
    return pairs.select("o_id", "p_id", S.equality_jaccard().alias("jaccard"))


def edge_pairs(o_edges: DataFrame, p_edges: DataFrame) -> DataFrame:
    """J2 (re-aimed): each edge of O with the same (src, dst) edge of P.

    ``cost_in_original`` repeats the reference's lookup of the perturbed
    edge's cost in the original graph (NULL = +Infinity). ``in_o`` and ``in_p`` say
    where the edge exists; a null weight does not.
    """
    o = o_edges.select("src", "dst", F.col("weight").alias("o_weight"), F.lit(True).alias("in_o"))
    p = p_edges.select("src", "dst", F.col("weight").alias("p_weight"), F.lit(True).alias("in_p"))
    j = o.join(p, ["src", "dst"], "full_outer")
    return j.select("src", "dst", "o_weight", "p_weight", F.col("o_weight").alias("cost_in_original"),
                    F.coalesce("in_o", F.lit(False)).alias("in_o"), F.coalesce("in_p", F.lit(False)).alias("in_p"))


def edge_scores(pairs: DataFrame) -> DataFrame:
    """X6 on edge pairs present in both graphs."""
    both = pairs.where(F.col("o_weight").isNotNull() & F.col("p_weight").isNotNull())
    return both.select("src", "dst", "o_weight", "p_weight", S.edge_score("o_weight", "p_weight").alias("score"))


def edge_set_jaccard(o_nodes: DataFrame, o_edges: DataFrame, p_nodes: DataFrame, p_edges: DataFrame) -> DataFrame:
    """Per node id present in both graphs, |E_O(v) ∩ E_P(v)| / |E_O(v) ∪ E_P(v)|.

    J6: one full outer join of the two edge sets gives presence flags; each
    edge is then attributed to both endpoints and counted.
    """
    o = o_edges.select("src", "dst", F.lit(1).alias("in_o"))
    p = p_edges.select("src", "dst", F.lit(1).alias("in_p"))
    j = o.join(p, ["src", "dst"], "full_outer").select(
        "src", "dst", F.coalesce("in_o", F.lit(0)).alias("in_o"), F.coalesce("in_p", F.lit(0)).alias("in_p"))
    ends = j.select(F.col("src").alias("node"), "in_o", "in_p").unionByName(
        j.where("src <> dst").select(F.col("dst").alias("node"), "in_o", "in_p"))
    counts = ends.groupBy("node").agg(
        F.sum(F.col("in_o") * F.col("in_p")).alias("inter"), F.count(F.lit(1)).alias("uni"))
    ids = o_nodes.select("id").join(p_nodes.select("id"), "id")
    res = ids.join(counts, ids["id"] == counts["node"], "left")
    inter = F.coalesce("inter", F.lit(0)).cast("bigint")
    uni = F.coalesce("uni", F.lit(0)).cast("bigint")
    return res.select("id", inter.alias("inter"), uni.alias("uni"),
                      F.when(uni == 0, F.lit(0.0)).otherwise(inter.cast("double") / uni.cast("double"))
                      .alias("jaccard"))


# ---------------------------------------------------------------------------
# Exact candidate join for the tolerant score
# ---------------------------------------------------------------------------

_INT_PROPS = {name: (S.tolerance(base), w) for name, base, w in C.TOLERANT_PROPS if name != "stored_value"}
_SV_FRAC = S.tolerance(dict((n, b) for n, b, _ in C.TOLERANT_PROPS)["stored_value"])
_SV_W = dict((n, w) for n, _, w in C.TOLERANT_PROPS)["stored_value"]
_WEIGHTS = {**{n: w for n, (_, w) in _INT_PROPS.items()}, "stored_value": _SV_W,
            "valuable_data": C.VALUABLE_POINTS}
_FRAC = {**{n: f for n, (f, _) in _INT_PROPS.items()}, "stored_value": _SV_FRAC}
_ZERO_BUCKET = -(2 ** 40)
_SMALL = 32  # integers up to here are their own bucket
_EPS = 1e-9


def _branches(min_points: int, props: list[str] | None = None, max_keys: int = 3) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """Disjoint (matched, excluded) property sets that cover every qualifying pair; with ``props`` by these alone."""
    order = sorted(props or _WEIGHTS, key=lambda n: (-_WEIGHTS[n], n))
    out = []

    def rec(matched: tuple, excluded: tuple):
        need = min_points - sum(_WEIGHTS[m] for m in matched)
        rest = [n for n in order if n not in matched and n not in excluded]
        avail = sum(_WEIGHTS[n] for n in rest)
        if need > avail:
            return  # cannot qualify
        if len(matched) >= max_keys or (need <= 0 and matched):
            out.append((matched, excluded))
            return
        slack = avail - need  # points that may still be missed
        group, acc = [], 0
        for n in rest:  # smallest heavy-first group that cannot be missed entirely
            group.append(n)
            acc += _WEIGHTS[n]
            if acc > slack:
                break
        if acc <= slack:  # every pair qualifies without a further match
            out.append((matched, excluded))
            return
        for i, n in enumerate(group):
            rec(matched + (n,), excluded + tuple(group[:i]))

    rec((), ())
    return out


def _bucket(name: str, v: F.Column) -> F.Column:
    """Bucket number of a value: never falls as the value grows, null for what cannot match."""
    log = F.floor(F.log(v) / math.log1p(_FRAC[name])).cast("bigint")
    if name == "stored_value":
        return F.when(v == 0, F.lit(_ZERO_BUCKET)).when(v > 0, log)
    base = math.floor(math.log(_SMALL) / math.log1p(_FRAC[name]))
    return F.when((v >= 0) & (v <= _SMALL), F.floor(v).cast("bigint")).when(v > _SMALL, log - base + _SMALL)


def _range(side: str, name: str) -> list[F.Column]:
    """First and last bucket of one property: of all that can match on the original side, of itself on the other."""
    if name == "valuable_data":
        one = F.when(F.col(f"{side}_{name}"), F.lit(1).cast("bigint"))
        return [one, one]
    v = F.col(f"{side}_{name}").cast("double")
    if side == "p":
        return [_bucket(name, v)] * 2
    if name == "stored_value":
        return [_bucket(name, v * (1 - _FRAC[name]) * (1 - _EPS)), _bucket(name, v * (1 + _FRAC[name]) * (1 + _EPS))]
    return [_bucket(name, F.ceil(v - v * _FRAC[name] - _EPS).cast("double")),
            _bucket(name, F.floor(v + v * _FRAC[name] + _EPS).cast("double"))]


def candidate_pairs(o_nodes: DataFrame, p_nodes: DataFrame, min_points: int = C.BEST_MATCH_MIN_POINTS,
                    props: list[str] | None = None) -> DataFrame:
    """All (o, p) pairs with tolerant points >= ``min_points``: ``(o_id, p_id, pts)``.

    With ``props`` the points of these alone count; the other properties must be null.

    Exact (equals brute force). All branches go through ONE equi-join on
    ``(branch, k0, k1, ...)``: each side is read once and its rows exploded into
    their keys; the branch's match / exclusion test runs after the join.
    """
    branches = _branches(min_points, props)
    if any(not m for m, _ in branches):
        raise ValueError(f"min_points={min_points} is too low for a candidate join")
    width = max(len(m) for m, _ in branches)
    keys = [f"k{i}" for i in range(width)]

    def keyed(nodes: DataFrame, side: str) -> DataFrame:
        rows = prefixed(nodes, f"{side}_")
        ends = [c.alias(f"_{e}_{n}") for n in _WEIGHTS for e, c in zip(("lo", "hi"), _range(side, n))]
        out = rows.select("*", *ends).select("*", F.explode(F.lit(list(range(len(branches))))).alias("branch"))
        for i, k in enumerate(keys):
            by_prop = {}
            for b, (matched, _) in enumerate(branches):
                by_prop.setdefault(matched[i] if i < len(matched) else None, []).append(b)

            def of_branch(end: str) -> F.Column:
                return F.coalesce(*[F.when(F.col("branch").isin(bs), F.col(f"_{end}_{n}") if n else F.lit(0).cast("bigint"))
                                    for n, bs in by_prop.items()])

            lo, hi = of_branch("lo"), of_branch("hi")
            out = out.select("*", F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias(k))
        return out.select(*rows.columns, "branch", *keys)

    j = keyed(o_nodes, "o").join(keyed(p_nodes, "p"), ["branch", *keys])
    # One bit per matching property; a branch wants some bits set and others not.
    bit = {n: 1 << i for i, n in enumerate(_WEIGHTS)}
    flags = S.tolerant_matches()
    mask = reduce(lambda x, y: x + y, [F.when(flags[n], F.lit(bit[n])).otherwise(F.lit(0)) for n in bit])
    wanted, barred = ([sum(bit[n] for n in names) for names in side] for side in zip(*branches))
    want = F.get(F.lit(wanted), F.col("branch"))
    test = mask.bitwiseAND(F.get(F.lit([w | x for w, x in zip(wanted, barred)]), F.col("branch"))) == want
    pts = S.tolerant_points()
    return j.where(test & (pts >= min_points)).select("o_id", "p_id", pts.alias("pts"))


def best_match(cands: DataFrame, top_k: int = 1) -> DataFrame:
    """Best original per perturbed node (highest points, ties: smallest id).

    ``top_k = 1`` is a partial ``max`` aggregate (map-side combine, no
    whole group in one task); larger ``k`` ranks candidates with the
    skew-safe :func:`prefix_rank` and keeps the first k.
    """
    if top_k == 1:
        best = cands.groupBy("p_id").agg(F.max(F.struct("pts", (-F.col("o_id")).alias("neg"))).alias("b"))
        return best.select("p_id", (-F.col("b.neg")).alias("o_id"), F.col("b.pts").alias("pts"),
                           S.rounded(S.points_score(F.col("b.pts"))).alias("score"))
    ranked = prefix_rank(cands.withColumn("_neg", -F.col("pts")), ["p_id"], ["_neg", "o_id"], out="_r")
    return (ranked.where(F.col("_r") < top_k)
            .select("p_id", "o_id", "pts", S.rounded(S.points_score("pts")).alias("score"),
                    (F.col("_r") + 1).alias("rank")))


LADDER = (75, 60)  # 75 points: every property but the flag
TOP_LADDER = (75, 69, 60, 50)


def profiles(nodes: DataFrame) -> DataFrame:
    """Distinct property tuples with ``id`` (the smallest) and ``n`` (how many nodes hold it), written once."""
    return cut_lineage(nodes.groupBy(*NODE_PROPS).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))


def expand(per_profile: DataFrame, p_profiles: DataFrame, p_nodes: DataFrame) -> DataFrame:
    """Rows keyed by the ``p_id`` of a profile, once for every node that holds it."""
    rep = p_profiles.select(F.col("id").alias("_rep"), *[F.col(c).alias(f"_{c}") for c in NODE_PROPS])
    members = (p_nodes.join(rep, [p_nodes[c].eqNullSafe(rep[f"_{c}"]) for c in NODE_PROPS])
               .select("_rep", F.col("id").alias("_member")))
    return (per_profile.join(members, per_profile["p_id"] == members["_rep"])
            .select(F.col("_member").alias("p_id"), *[c for c in per_profile.columns if c != "p_id"]))


_CELL_PROPS = [c for c in NODE_PROPS if c != "stored_value"]
_FINE = 6  # buckets of stored values in the width of their tolerance
_ROUND = 1e-9  # how far around the ends of a range a bucket is not taken as lying inside


def _fine_bucket(v: F.Column) -> F.Column:
    """Number of the narrow bucket of a stored value: never falls as the value grows, null for what cannot match."""
    return F.when(v == 0, F.lit(_ZERO_BUCKET)).when(v > 0, F.floor(F.log(v) / (math.log1p(_SV_FRAC) / _FINE)).cast("bigint"))


def _celled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells of ``rows`` (distinct values of all but the stored value) as nodes, and ``(id, cell, stored_value, num)``, ``num`` a row's own."""
    cells = cut_lineage(rows.groupBy(*_CELL_PROPS).agg(F.count(F.lit(1)).alias("_n")).withColumn("cell", F.monotonically_increasing_id()).drop("_n"))
    placed = rows.join(cells, [rows[c].eqNullSafe(cells[c]) for c in _CELL_PROPS]).select("id", "cell", "stored_value")
    nodes = cells.withColumnRenamed("cell", "id").withColumn("stored_value", F.lit(None).cast("double"))
    return nodes.select(*NODE_FIELDS), cut_lineage(placed.withColumn("num", F.monotonically_increasing_id()))


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` rows with most ``pts``, ties by smaller ``o_id``, of each group: ``(keys, pts, o_id, num)``."""
    if k == 1:
        best = rows.groupBy(*keys).agg(F.max(F.struct("pts", (-F.col("o_id")).alias("neg"), "num")).alias("b"))
        return best.select(*keys, "b.pts", (-F.col("b.neg")).alias("o_id"), "b.num")
    order = Window.partitionBy(*keys).orderBy(F.desc("pts"), "o_id", "num")  # cut to k rows a partition before the shuffle
    return rows.select(*keys, "pts", "o_id", "num").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def _best_of(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` originals of every ``p_id``; one that is named twice counts with its most points."""
    once = rows if k == 1 else rows.groupBy("p_id", "num", "o_id").agg(F.max("pts").alias("pts"))
    return _first(once.select("p_id", "pts", "o_id", "num"), ["p_id"], k)


def _first_matches(o_cells: DataFrame, o_rows: DataFrame, p_cells: DataFrame, p_rows: DataFrame, k: int, t: int) -> DataFrame:
    """``(p_id, pts, o_id, num)``: the first ``k`` originals of every profile that reach ``t`` points with it.

    Cells are joined, not rows. An original of a matching cell has the cell's points, and those of the stored
    value if it lies in the profile's range. The first ``k`` originals of all cells that a cell meets are kept
    for each narrow bucket of stored values; buckets inside a range are read as they are, and of the two at its
    ends those originals are tested one by one that would come before what the others gave. So a profile meets
    a bounded number of rows, however many originals reach ``t``.
    """
    near = candidate_pairs(o_cells, p_cells, t - _SV_W, _CELL_PROPS).select(F.col("o_id").alias("cell"), F.col("p_id").alias("pc"), F.col("pts").alias("base"))
    if k == 1:  # further down not even the stored value makes up for the best cell
        top = Window.partitionBy("pc")
        near = near.withColumn("_top", F.max("base").over(top)).where(F.col("base") >= F.col("_top") - _SV_W).drop("_top")
    near = cut_lineage(near)
    held = o_rows.select("cell", _fine_bucket(F.col("stored_value")).alias("bucket"), "stored_value", F.col("id").alias("o_id"), "num")
    by_bucket = cut_lineage(_first(held.where("bucket is not null").withColumn("pts", F.lit(0).cast("bigint")), ["cell", "bucket"], k).drop("pts"))
    in_cell = _first(held.withColumn("pts", F.lit(0).cast("bigint")), ["cell"], k).drop("pts")
    index = cut_lineage(_first(near.join(by_bucket, "cell").select("pc", "bucket", (F.col("base") + _SV_W).alias("pts"), "o_id", "num"), ["pc", "bucket"], k))
    plain = _first(near.where(F.col("base") >= t).join(in_cell, "cell").select("pc", F.col("base").alias("pts"), "o_id", "num"), ["pc"], k)

    v = F.col("p_stored_value")
    profile = p_rows.select(F.col("id").alias("p_id"), F.col("cell").alias("pc"), F.col("stored_value").alias("p_stored_value"))
    low, high = v / (1 + _SV_FRAC), v / (1 - _SV_FRAC)
    ends = [_fine_bucket(c) for c in (low * (1 - _ROUND), low * (1 + _ROUND), high * (1 - _ROUND), high * (1 + _ROUND))]
    asked = profile.where("p_stored_value >= 0").select(
        "*", F.explode(F.sequence(ends[0], ends[3])).alias("bucket"), ends[1].alias("_a"), ends[2].alias("_z"))
    asked = asked.withColumn("inside", (v == 0) | (F.col("bucket") > F.col("_a")) & (F.col("bucket") < F.col("_z")))
    met = cut_lineage(asked.join(index, ["pc", "bucket"]).select("p_id", "pc", "p_stored_value", "bucket", "inside", "pts", "o_id", "num"))
    sure = cut_lineage(_best_of(met.where("inside").select("p_id", "pts", "o_id", "num")
                                .unionByName(profile.join(plain, "pc").select("p_id", "pts", "o_id", "num")), k))
    last = sure.groupBy("p_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("pts", (-F.col("o_id")).alias("neg"))).alias("_last")).where(F.col("_n") >= k)
    before = F.col("_last").isNull() | (F.struct("pts", (-F.col("o_id")).alias("neg")) > F.col("_last"))
    open_ends = (met.where("not inside").join(last.drop("_n"), "p_id", "left").where(before)
                 .select("p_id", "pc", "p_stored_value", "bucket", "_last").distinct())
    cells = (open_ends.join(near, "pc").join(by_bucket.groupBy("cell", "bucket").agg(F.min("o_id").alias("o_id")), ["cell", "bucket"])
             .withColumn("pts", F.col("base") + _SV_W).where(before).drop("o_id"))
    tested = (cells.join(held.withColumnRenamed("stored_value", "o_stored_value"), ["cell", "bucket"])
              .where(before & S.tolerant_match("o_stored_value", "p_stored_value", _SV_FRAC)))
    return _best_of(sure.unionByName(tested.select("p_id", "pts", "o_id", "num")), k)


def _ladder_matches(o_nodes: DataFrame, p_prof: DataFrame, k: int, min_points: int, ladder: tuple[int, ...]) -> DataFrame:
    """``(p_id, pts, o_id)``: the first ``k`` originals of every profile, under falling bounds.

    A profile stops at the first bound that ``k`` originals reach, since all others have fewer points.
    """
    if min_points <= _SV_W:
        raise ValueError(f"min_points={min_points} is too low for a candidate join")
    o_cells, o_rows = _celled(o_nodes)
    p_cells, rest = _celled(p_prof)
    found = []
    for t in [t for t in sorted(set(ladder), reverse=True) if t > min_points] + [min_points]:
        open_cells = p_cells.join(rest.select(F.col("cell").alias("id")).distinct(), "id", "left_semi")
        best = cut_lineage(_first_matches(o_cells, o_rows, open_cells, rest, k, t))
        if t > min_points:
            done = best.groupBy("p_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select("p_id")
            best = best.join(done, "p_id", "left_semi")
            rest = cut_lineage(rest.join(done, F.col("id") == F.col("p_id"), "left_anti"))
        found.append(best)
        if t > min_points and rest.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).select("p_id", "pts", "o_id", "num")


def best_match_exact(o_nodes: DataFrame, p_nodes: DataFrame, min_points: int = C.BEST_MATCH_MIN_POINTS,
                     ladder: tuple[int, ...] = LADDER) -> DataFrame:
    """X10 top-1 without enumerating every qualifying pair.

    Thresholds are tried from high to low: a perturbed profile whose best pair
    reaches a higher threshold has its exact best among those pairs, so only the
    ones left without a match go on to the next (wider) one. Equal to
    ``best_match(candidate_pairs(o, p, min_points))``.
    """
    p_prof = profiles(p_nodes)
    best = _ladder_matches(profiles(o_nodes), p_prof, 1, min_points, ladder)
    return expand(best.select("p_id", "o_id", "pts", S.rounded(S.points_score("pts")).alias("score")), p_prof, p_nodes)


def best_match_top(o_nodes: DataFrame, p_nodes: DataFrame, k: int, min_points: int = C.BEST_MATCH_MIN_POINTS,
                   ladder: tuple[int, ...] = TOP_LADDER) -> DataFrame:
    """X10 with ``k`` matches a node: ``(p_id, o_id, pts, score, rank)``, ties by smaller original id.

    A perturbed profile stops at the first bound above which it has ``k`` original nodes, copies included.
    """
    p_prof = profiles(p_nodes)
    first = _ladder_matches(o_nodes, p_prof, k, min_points, ladder)
    rank = F.row_number().over(Window.partitionBy("p_id").orderBy(F.desc("pts"), "o_id", "num")).cast("bigint")
    per_profile = first.select("p_id", "o_id", "pts", S.rounded(S.points_score("pts")).alias("score"), rank.alias("rank"))
    return expand(per_profile, p_prof, p_nodes)


RANGED = ("stored_value", "prop_value_range")  # what the classes of :func:`match_counts` leave out
_EDGE = 1e-12  # how far around the ends of a range a stored value is tested for itself


def _classes(prof: DataFrame, props: list[str]) -> tuple[DataFrame, DataFrame]:
    """The distinct values of ``props`` as nodes without the ranged properties, and the profiles with their class."""
    classes = cut_lineage(prof.groupBy(*props).agg(F.min("id").alias("class")))
    rows = prof.join(classes, [prof[c].eqNullSafe(classes[c]) for c in props]).select(
        "id", "n", "class", F.col("prop_value_range").cast("bigint").alias("pvr"), "stored_value")
    nodes = classes.withColumnRenamed("class", "id").withColumn("prop_value_range", F.lit(None).cast("bigint")).withColumn(
        "stored_value", F.lit(None).cast("double"))
    return nodes.select(*NODE_FIELDS), cut_lineage(rows)


def _matching_values(o_rows: DataFrame, p_rows: DataFrame) -> DataFrame:
    """``(pvr, o_pvr)``: the value ranges of originals that each value range of the other side matches."""
    name = "prop_value_range"
    o = o_rows.select(F.col("pvr").alias(f"o_{name}")).where("pvr is not null").distinct()
    p = p_rows.select(F.col("pvr").alias(f"p_{name}")).where("pvr is not null").distinct()
    lo, hi = _range("o", name)
    o = o.withColumn("k", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    met = o.join(p.withColumn("k", _range("p", name)[0]), "k")
    return met.where(S.tolerant_match(f"o_{name}", f"p_{name}", _FRAC[name])).select(F.col(f"p_{name}").alias("pvr"), F.col(f"o_{name}").alias("o_pvr"))


def _matching_spans(o_rows: DataFrame, p_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(stored_value, num)`` of the originals, numbered in order, and ``(p_value, lo, hi)``: what each asked value matches, ``lo <= num < hi``.

    Distinct values alone are ordered. Those within a rounding error of an end are tested one by one; each that
    matches is a span of its own.
    """
    held = o_rows.where("stored_value >= 0").select("stored_value").distinct()
    asked = p_rows.where("stored_value >= 0").select(F.col("stored_value").alias("p_value")).distinct()
    low, high = F.col("p_value") / (1 + _SV_FRAC), F.col("p_value") / (1 - _SV_FRAC)
    # order 0: before the originals of a value, 1: the originals, 2: after them
    end = lambda v, order, name: F.struct(v.alias("at"), F.lit(order).alias("order"), F.lit(name).alias("end"))
    ends = F.explode(F.array(end(low * (1 + _EDGE), 0, "a"), end(high * (1 - _EDGE), 2, "b"), end(low * (1 - _EDGE), 0, "c"), end(high * (1 + _EDGE), 2, "d")))
    line = asked.select("p_value", ends.alias("e")).select("p_value", "e.*", F.lit(0).cast("bigint").alias("rows")).unionByName(
        held.select(F.lit(None).cast("double").alias("p_value"), F.col("stored_value").alias("at"), F.lit(1).alias("order"),
                    F.lit(None).cast("string").alias("end"), F.lit(1).cast("bigint").alias("rows")))
    run = cut_lineage(prefix_sum(line, [], ["at", "order"], {"before": "rows"}))
    numbered = run.where("end is null").select(F.col("at").alias("stored_value"), (F.col("before") - 1).alias("num"))
    at = lambda name: F.max(F.when(F.col("end") == name, F.col("before"))).alias(name)
    bounds = cut_lineage(run.where("end is not null").groupBy("p_value").agg(*[at(name) for name in "abcd"]))
    few = lambda lo, hi: bounds.where(F.col(lo) < F.col(hi)).select("p_value", F.explode(F.sequence(F.col(lo), F.col(hi) - 1)).alias("i"))
    tested = (few("c", "a").unionByName(few("b", "d")).join(numbered, F.col("i") == F.col("num"))
              .where(S.tolerant_match("stored_value", "p_value", _SV_FRAC)).select("p_value", F.col("num").alias("lo"), (F.col("num") + 1).alias("hi")))
    return numbered, bounds.select("p_value", F.col("a").alias("lo"), F.col("b").alias("hi")).where("lo < hi").unionByName(tested)


def _span_counts(asked: DataFrame, points: DataFrame) -> DataFrame:
    """``(p_id, n)``: per ``p_id`` the sum over its rows ``(class, g, lo, hi, sign)`` of ``sign`` times the originals of ``(class, g)`` with ``lo <= num < hi``.

    Originals and both ends of every span lie in one line per ``(class, g)``, an end before the original of its
    number, and a running sum is read at the ends.
    """
    nothing = F.lit(0).cast("bigint")
    end = lambda c, sign: F.struct((F.col(c) * 2).alias("pos"), sign.alias("sign"))
    ends = asked.select("p_id", "class", "g", F.explode(F.array(end("lo", -F.col("sign")), end("hi", F.col("sign")))).alias("e"))
    line = ends.select("p_id", "class", "g", "e.pos", "e.sign", nothing.alias("n")).unionByName(
        points.select(F.lit(None).cast("bigint").alias("p_id"), "class", "g", (F.col("num") * 2 + 1).alias("pos"), F.lit(0).alias("sign"), "n"))
    run = prefix_sum(line, ["class", "g"], ["pos"], {"upto": "n"}, hot=HOT).where("p_id is not null")
    return run.groupBy("p_id").agg(F.sum(F.col("sign") * F.col("upto")).alias("n"))


def match_counts(o_prof: DataFrame, p_prof: DataFrame, min_points: int = C.BEST_MATCH_MIN_POINTS) -> DataFrame:
    """``(p_id, n_matches)``: how many originals reach ``min_points`` with a profile, without their pairs.

    Profiles are put into classes by all properties but the two ranged ones. What two classes have in common
    decides what is still needed: nothing, either ranged property, the stored value, or both; by inclusion
    and exclusion that is a sum of counts of originals by value range, by a range of stored values, and by
    both. Originals stay in their own class: each lies twice in the order of stored values, among its class
    and among those of its class with the same value range, and a profile reads a running sum of every class
    it meets at the ends of its range. So rows are the originals, plus profiles times classes and value ranges
    met; the latter do not grow with the originals once all combinations of the small properties occur.
    """
    props = [c for c in NODE_PROPS if c not in RANGED]
    w_value, w_range = _WEIGHTS["stored_value"], _WEIGHTS["prop_value_range"]
    if w_range > w_value or min_points <= w_value + w_range:
        raise ValueError(f"min_points={min_points} is too low to count by classes")
    o_classes, o_rows = _classes(o_prof, props)
    p_classes, p_rows = _classes(p_prof, props)
    need = min_points - F.col("pts")
    band = F.when(need <= 0, "all").when(need <= w_range, "either").when(need <= w_value, "value").otherwise("both")
    pairs = cut_lineage(candidate_pairs(o_classes, p_classes, min_points - w_value - w_range, props)
                        .select(F.col("o_id").alias("class"), F.col("p_id").alias("pc"), band.alias("band")))
    sizes = cut_lineage(o_rows.groupBy("class", F.col("pvr").alias("o_pvr")).agg(F.sum("n").alias("n")))
    matching = cut_lineage(_matching_values(o_rows, p_rows))
    profile = p_rows.select(F.col("id").alias("p_id"), F.col("class").alias("pc"), "pvr", F.col("stored_value").alias("p_value"))

    total = pairs.where("band = 'all'").join(sizes, "class").groupBy("pc").agg(F.sum("n").alias("n"))
    by_range = pairs.where("band = 'either'").join(sizes, "class").groupBy("pc", "o_pvr").agg(F.sum("n").alias("n"))

    # either = by range + by value - both; group null: whatever the value range
    numbered, spans = _matching_spans(o_rows, p_rows)
    valued = o_rows.join(numbered, "stored_value").select("class", "pvr", "num", "n")
    points = (valued.groupBy("class", "num").agg(F.sum("n").alias("n")).withColumn("g", F.lit(None).cast("bigint"))
              .unionByName(valued.where("pvr is not null").select("class", F.col("pvr").alias("g"), "num", "n")))
    sign = F.when(F.col("band") == "both", 1).otherwise(-1)
    in_span = profile.join(spans, "p_value").select("p_id", "pc", "pvr", "lo", "hi")
    whole = in_span.join(pairs.where("band in ('either', 'value')"), "pc").select(
        "p_id", "class", F.lit(None).cast("bigint").alias("g"), "lo", "hi", F.lit(1).alias("sign"))
    ranged = in_span.join(matching, "pvr").join(pairs.where("band in ('either', 'both')"), "pc").select(
        "p_id", "class", F.col("o_pvr").alias("g"), "lo", "hi", sign.alias("sign"))
    parts = (_span_counts(whole.unionByName(ranged), cut_lineage(points))
             .unionByName(profile.join(matching, "pvr").join(by_range, ["pc", "o_pvr"]).select("p_id", "n"))
             .unionByName(profile.join(total, "pc").select("p_id", "n")))
    return parts.groupBy("p_id").agg(F.sum("n").cast("bigint").alias("n_matches"))


def best_match_counted(o_nodes: DataFrame, p_nodes: DataFrame, min_points: int = C.BEST_MATCH_MIN_POINTS) -> DataFrame:
    """Best match of every perturbed node and ``n_matches``, the originals that reach ``min_points``."""
    o_prof, p_prof = profiles(o_nodes), profiles(p_nodes)
    counted = expand(match_counts(o_prof, p_prof, min_points), p_prof, p_nodes)
    return best_match_exact(o_nodes, p_nodes, min_points).join(counted, "p_id")
