"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

from .. import constants as C
from ..schemas import NODE_PROPS
from .fixture_sql import with_ctes

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


_DIFF_COLS = ", ".join(
    f"CASE WHEN o.{c} IS DISTINCT FROM p.{c} THEN '{c}' END" for c in NODE_PROPS)

NODE_DIFF = f"""
node_d AS (
  SELECT coalesce(o.id, p.id) AS id,
         CASE WHEN o.id IS NULL THEN 'Added' WHEN p.id IS NULL THEN 'Removed'
              WHEN concat_ws(',', {_DIFF_COLS}) <> '' THEN 'Modified' ELSE 'Same' END AS change,
         CASE WHEN o.id IS NOT NULL AND p.id IS NOT NULL THEN concat_ws(',', {_DIFF_COLS}) END AS changed_cols
  FROM o_nodes o FULL OUTER JOIN p_nodes p ON o.id = p.id)
"""

EDGE_DIFF = """
edge_d AS (
  SELECT coalesce(o.src, p.src) AS src, coalesce(o.dst, p.dst) AS dst,
         CASE WHEN o.src IS NULL THEN 'Added' WHEN p.src IS NULL THEN 'Removed'
              WHEN o.weight IS DISTINCT FROM p.weight THEN 'Modified' ELSE 'Same' END AS change,
         o.weight AS o_weight, p.weight AS p_weight
  FROM o_edges o FULL OUTER JOIN p_edges p ON o.src = p.src AND o.dst = p.dst)
"""

_VALUE_EQ = " AND ".join(f"o.{c} = p.{c}" for c in ["id", *NODE_PROPS])
PRESENT = f"""
present AS (SELECT o.id FROM o_nodes o JOIN p_nodes p ON {_VALUE_EQ})
"""

oracle("q_node_diff", with_ctes("SELECT id, change, changed_cols FROM node_d", NODE_DIFF))
oracle("q_edge_diff", with_ctes("SELECT * FROM edge_d", EDGE_DIFF))
oracle("q_diff_summary", with_ctes("""
SELECT 'node' AS entity, change, count(*) AS n FROM node_d GROUP BY change
UNION ALL
SELECT 'edge', change, count(*) FROM edge_d GROUP BY change""", NODE_DIFF, EDGE_DIFF))

oracle("q_successors", with_ctes("""
SELECT src AS node, dst AS nbr, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS pos FROM p_edges"""))
oracle("q_predecessors", with_ctes("""
SELECT dst AS node, src AS nbr, row_number() OVER (PARTITION BY dst ORDER BY src) - 1 AS pos FROM p_edges"""))

UNDIRECTED = """
und AS (SELECT src AS node, dst AS nbr FROM p_edges UNION SELECT dst, src FROM p_edges)
"""
oracle("q_adjacent", with_ctes("""
SELECT node, nbr, row_number() OVER (PARTITION BY node ORDER BY nbr) - 1 AS pos FROM und""", UNDIRECTED))

oracle("q_incident_edges", with_ctes("""
SELECT src AS node, src, dst, weight, 'out' AS direction FROM p_edges
UNION ALL
SELECT dst, src, dst, weight, 'in' FROM p_edges WHERE src <> dst"""))

oracle("q_degrees", with_ctes("""
SELECT n.id, coalesce(i.c, 0) AS in_deg, coalesce(o.c, 0) AS out_deg,
       coalesce(i.c, 0) + coalesce(o.c, 0) AS degree
FROM p_nodes n
LEFT JOIN (SELECT dst AS node, count(*) AS c FROM p_edges GROUP BY dst) i ON i.node = n.id
LEFT JOIN (SELECT src AS node, count(*) AS c FROM p_edges GROUP BY src) o ON o.node = n.id"""))

oracle("q_edge_cost", with_ctes("""
SELECT p.src, p.dst, p.weight AS own_cost, o.weight AS cost_in_original,
       CASE WHEN o.weight IS NULL THEN '-' ELSE printf('%.3f', o.weight) END AS cost_text
FROM p_edges p LEFT JOIN o_edges o ON o.src = p.src AND o.dst = p.dst"""))

oracle("q_walk_start", with_ctes("""
SELECT i.init_id, coalesce((SELECT min(dst) FROM p_edges WHERE src = i.init_id), i.init_id) AS start_id
FROM (SELECT min(src) AS init_id FROM p_edges) i"""))

oracle("q_valuable_nodes", with_ctes("SELECT * FROM p_nodes WHERE valuable_data"))

oracle("q_discarded_nodes", with_ctes("""
SELECT o.id, CASE WHEN p.id IS NULL THEN 'removed' ELSE 'modified' END AS reason
FROM o_nodes o LEFT JOIN p_nodes p ON o.id = p.id
WHERE o.id NOT IN (SELECT id FROM present)""", PRESENT))

DEGREES_OP = """
deg_o AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM o_edges UNION ALL SELECT dst FROM o_edges) GROUP BY node),
deg_p AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM p_edges UNION ALL SELECT dst FROM p_edges) GROUP BY node),
shared AS (SELECT o.src, o.dst FROM o_edges o JOIN p_edges p ON o.src = p.src AND o.dst = p.dst),
shared_deg AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM shared UNION ALL SELECT dst FROM shared WHERE src <> dst) GROUP BY node),
inc_o AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM o_edges UNION ALL SELECT dst FROM o_edges WHERE src <> dst) GROUP BY node)
"""

CONFIDENCE = """
conf AS (
  SELECT n.id, coalesce(i.c, 0) AS n_edges, coalesce(m.c, 0) AS shared,
         coalesce(a.c, 0) = coalesce(b.c, 0) AS same_degree,
         pr.id IS NOT NULL AS present,
         CASE WHEN pr.id IS NULL OR coalesce(i.c, 0) = 0 THEN CAST(0 AS DOUBLE)
              ELSE least(CAST(1 AS DOUBLE),
                         CAST(1 + CASE WHEN coalesce(a.c, 0) = coalesce(b.c, 0) THEN coalesce(m.c, 0) ELSE 0 END AS DOUBLE)
                         / CAST(i.c AS DOUBLE)) END AS score
  FROM o_nodes n
  LEFT JOIN present pr ON pr.id = n.id
  LEFT JOIN inc_o i ON i.node = n.id
  LEFT JOIN deg_o a ON a.node = n.id
  LEFT JOIN deg_p b ON b.node = n.id
  LEFT JOIN shared_deg m ON m.node = n.id)
"""
oracle("q_confidence", with_ctes("SELECT * FROM conf", PRESENT, DEGREES_OP, CONFIDENCE))




# --- Step 2: pairing and scoring ----------------------------------------------

def dlit(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _tol(base: float) -> float:
    return (base * (1 + C.TOLERANCE_MODIFIER)) / 100.0


def tolerant_match_sql(name: str, base: float, o: str = "o", p: str = "p") -> str:
    return (f"(abs(CAST({o}.{name} AS DOUBLE) - CAST({p}.{name} AS DOUBLE)) "
            f"<= CAST({o}.{name} AS DOUBLE) * {dlit(_tol(base))})")


def tolerant_points_sql(o: str = "o", p: str = "p") -> str:
    terms = [f"CASE WHEN {tolerant_match_sql(n, b, o, p)} THEN {w} ELSE 0 END" for n, b, w in C.TOLERANT_PROPS]
    terms.append(f"CASE WHEN coalesce({o}.valuable_data AND {p}.valuable_data, false) THEN {C.VALUABLE_POINTS} ELSE 0 END")
    return "CAST((" + " + ".join(terms) + ") AS BIGINT)"


def changed_sql(o: str = "o", p: str = "p") -> str:
    terms = [f"CASE WHEN {tolerant_match_sql(n, b, o, p)} THEN 0 ELSE 1 END" for n, b, _ in C.TOLERANT_PROPS]
    terms.append(f"CASE WHEN coalesce({o}.valuable_data AND {p}.valuable_data, false) THEN 0 ELSE 1 END")
    return "CAST((" + " + ".join(terms) + ") AS BIGINT)"


def score_sql(pts: str) -> str:
    return f"CASE WHEN {pts} > 0 THEN CAST({pts} AS DOUBLE) / {dlit(81.0)} ELSE {dlit(0.0)} END"


def strict_points_sql(o: str = "o", p: str = "p") -> str:
    terms = [f"CASE WHEN {o}.{n} = {p}.{n} THEN {w} ELSE 0 END" for n, w in C.STRICT_PROPS]
    ratio_small = (f"(CASE WHEN {p}.stored_value = 0 THEN false ELSE "
                   f"{o}.stored_value / {p}.stored_value <= {dlit(C.STRICT_STORED_VALUE_RATIO)} END)")
    terms.append(f"CASE WHEN NOT {ratio_small} THEN {C.STRICT_STORED_VALUE_POINTS} ELSE 0 END")
    return "CAST((" + " + ".join(terms) + ") AS BIGINT)"


def jaccard_sql(o: str = "o", p: str = "p") -> str:
    terms = [f"CASE WHEN {o}.{n} = {p}.{n} THEN 1 ELSE 0 END" for n, _, _ in C.TOLERANT_PROPS]
    return "CAST((" + " + ".join(terms) + ") AS DOUBLE) / " + dlit(8.0)


PAIR_COLS = ["id", "children", "props", "current_depth", "prop_value_range", "max_depth",
             "max_branching_factor", "max_properties", "stored_value"]

oracle("q_node_pairs", with_ctes(
    "SELECT " + ", ".join(f"{s}.{c} AS {s}_{c}" for s in ("o", "p") for c in PAIR_COLS)
    + " FROM o_nodes o FULL OUTER JOIN p_nodes p ON o.id = p.id"))

PTS = tolerant_points_sql()
oracle("q_node_score", with_ctes(f"""
SELECT o_id, p_id, pts, changed, round({score_sql('pts')}, 2) AS score, pts >= {C.BEST_MATCH_MIN_POINTS} AS authentic
FROM (SELECT o.id AS o_id, p.id AS p_id, {PTS} AS pts, {changed_sql()} AS changed
      FROM o_nodes o JOIN p_nodes p ON o.id = p.id)"""))

oracle("q_node_score_strict", with_ctes(f"""
SELECT o_id, p_id, pts, {score_sql('pts')} AS score
FROM (SELECT o.id AS o_id, p.id AS p_id, {strict_points_sql()} AS pts FROM o_nodes o JOIN p_nodes p ON o.id = p.id)"""))

oracle("q_node_jaccard", with_ctes(f"""
SELECT o.id AS o_id, p.id AS p_id, {jaccard_sql()} AS jaccard FROM o_nodes o JOIN p_nodes p ON o.id = p.id"""))

EDGE_PAIRS = """
edge_pairs AS (
  SELECT coalesce(o.src, p.src) AS src, coalesce(o.dst, p.dst) AS dst,
         o.weight AS o_weight, p.weight AS p_weight, o.weight AS cost_in_original
  FROM o_edges o FULL OUTER JOIN p_edges p ON o.src = p.src AND o.dst = p.dst)
"""
EDGE_SCORES = f"""
edge_scores AS (
  SELECT src, dst, o_weight, p_weight,
         CASE WHEN abs(o_weight - p_weight) <= o_weight * {dlit(C.EDGE_WEIGHT_TOLERANCE / 100.0)}
              THEN {dlit(C.EDGE_MATCH_SCORE)} ELSE {dlit(0.0)} END AS score
  FROM edge_pairs WHERE o_weight IS NOT NULL AND p_weight IS NOT NULL)
"""
oracle("q_edge_pairs", with_ctes("SELECT * FROM edge_pairs", EDGE_PAIRS))
oracle("q_edge_score", with_ctes("SELECT * FROM edge_scores", EDGE_PAIRS, EDGE_SCORES))

oracle("q_edge_set_jaccard", with_ctes(f"""
SELECT i.id, coalesce(c.inter, 0) AS inter, coalesce(c.uni, 0) AS uni,
       CASE WHEN coalesce(c.uni, 0) = 0 THEN {dlit(0.0)}
            ELSE CAST(coalesce(c.inter, 0) AS DOUBLE) / CAST(c.uni AS DOUBLE) END AS jaccard
FROM (SELECT o.id FROM o_nodes o JOIN p_nodes p ON o.id = p.id) i
LEFT JOIN (
  SELECT node, CAST(sum(in_o * in_p) AS BIGINT) AS inter, count(*) AS uni
  FROM (SELECT src AS node, in_o, in_p FROM j UNION ALL SELECT dst, in_o, in_p FROM j WHERE src <> dst) GROUP BY node) c
ON c.node = i.id""", """
j AS (SELECT coalesce(o.src, p.src) AS src, coalesce(o.dst, p.dst) AS dst,
             CASE WHEN o.src IS NULL THEN 0 ELSE 1 END AS in_o, CASE WHEN p.src IS NULL THEN 0 ELSE 1 END AS in_p
      FROM o_edges o FULL OUTER JOIN p_edges p ON o.src = p.src AND o.dst = p.dst)
"""))

BEST = f"""
all_pairs AS (SELECT o.id AS o_id, p.id AS p_id, {PTS} AS pts FROM o_nodes o, p_nodes p),
best AS (
  SELECT p_id, arg_min(o_id, (-pts, o_id)) AS o_id, max(pts) AS pts
  FROM all_pairs WHERE pts >= {C.BEST_MATCH_MIN_POINTS} GROUP BY p_id)
"""
oracle("q_best_match", with_ctes(f"SELECT p_id, o_id, pts, round({score_sql('pts')}, 2) AS score FROM best", BEST))

oracle("q_confidence_pairs", with_ctes("""
SELECT b.o_id AS original_id, b.p_id AS perturbed_id, coalesce(i.c, 0) AS n_edges, coalesce(m.c, 0) AS shared,
       CASE WHEN pr.id IS NULL OR coalesce(i.c, 0) = 0 THEN CAST(0 AS DOUBLE)
            ELSE least(CAST(1 AS DOUBLE),
                       CAST(1 + CASE WHEN coalesce(a.c, 0) = coalesce(bb.c, 0) THEN coalesce(m.c, 0) ELSE 0 END AS DOUBLE)
                       / CAST(i.c AS DOUBLE)) END AS score
FROM best b
LEFT JOIN inc_o i ON i.node = b.o_id
LEFT JOIN present pr ON pr.id = b.o_id
LEFT JOIN deg_o a ON a.node = b.o_id
LEFT JOIN deg_p bb ON bb.node = b.o_id
LEFT JOIN (
  SELECT b2.o_id, b2.p_id, count(*) AS c FROM best b2 JOIN shared s
    ON (b2.o_id = b2.p_id AND (s.src = b2.o_id OR s.dst = b2.o_id))
    OR (b2.o_id <> b2.p_id AND ((s.src = b2.o_id AND s.dst = b2.p_id) OR (s.dst = b2.o_id AND s.src = b2.p_id)))
  GROUP BY b2.o_id, b2.p_id) m ON m.o_id = b.o_id AND m.p_id = b.p_id""", PRESENT, DEGREES_OP, BEST))

_NODE_VALUES = "SELECT id, children, props, current_depth, prop_value_range, max_depth, " \
               "max_branching_factor, max_properties, stored_value, valuable_data"
oracle("q_parse_nodes", with_ctes(_NODE_VALUES + ", CAST(10 AS INTEGER) AS arity FROM p_nodes"))
oracle("q_nodes_json_roundtrip", with_ctes(_NODE_VALUES + " FROM p_nodes"))
oracle("q_extract_node_number", with_ctes(
    "SELECT coalesce(o.id, p.id) AS line_id, p.id AS node_number FROM o_nodes o FULL OUTER JOIN p_nodes p ON o.id = p.id"))

# --- Step 3: metrics ----------------------------------------------------------


def link_stats_sql(atl: str, wtl: str, gtl: str, btl: str, rtl: str) -> str:
    a, w, g, b, r = (f"CAST({x} AS DOUBLE)" for x in (atl, wtl, gtl, btl, rtl))
    return (f"CASE WHEN {r} <> 0 THEN {a} / {r} END AS acc, "
            f"CASE WHEN {g} = {r} AND {b} = 0 THEN {dlit(1.0)} WHEN {b} = {r} AND {g} = 0 THEN {dlit(0.0)} "
            f"WHEN {r} <> 0 THEN ({a} - {w}) / ({r} * {dlit(2.0)}) + {dlit(0.5)} END AS vpr, "
            f"CASE WHEN {r} <> 0 THEN {w} / {r} END AS btlr")


def pct_sql(num: str, den: str) -> str:
    n, d = f"CAST({num} AS DOUBLE)", f"CAST({den} AS DOUBLE)"
    return f"CASE WHEN {d} <> 0 THEN greatest({dlit(0.0)}, least({dlit(100.0)}, {n} / {d} * {dlit(100.0)})) END"


def cnt(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


oracle("q_edge_traceability", with_ctes(f"""
SELECT node, atl, tp, wtl, above, even, ctl, wtl_links, dtl,
       dtl + even + above AS gtl, ctl + wtl_links AS btl, dtl + even + above + ctl + wtl_links AS rtl,
       {link_stats_sql('atl', 'wtl', 'dtl + even + above', 'ctl + wtl_links', 'dtl + even + above + ctl + wtl_links')}
FROM (SELECT src AS node,
        {cnt(f'score >= {dlit(C.EDGE_ACCEPT)}')} AS atl, {cnt(f'score >= {dlit(C.EDGE_KEEP)}')} AS tp,
        {cnt(f'score < {dlit(C.EDGE_KEEP)}')} AS wtl, {cnt(f'score > {dlit(C.EDGE_ACCEPT)}')} AS above,
        {cnt(f'score = {dlit(C.EDGE_ACCEPT)}')} AS even, {cnt(f'score > {dlit(C.EDGE_CTL)}')} AS ctl,
        {cnt(f'score < {dlit(C.EDGE_WTL)}')} AS wtl_links, {cnt(f'score < {dlit(C.EDGE_DTL)}')} AS dtl
      FROM edge_scores GROUP BY src)""", EDGE_PAIRS, EDGE_SCORES))

NODE_SCORES = f"""
node_scores AS (
  SELECT o_id, p_id, round({score_sql('pts')}, 2) AS score
  FROM (SELECT o.id AS o_id, p.id AS p_id, {PTS} AS pts FROM o_nodes o JOIN p_nodes p ON o.id = p.id))
"""
oracle("q_node_traceability", with_ctes(f"""
SELECT atl, tp, wtl, fp, even, ctl, wtl_links, dtl, pairs, {pct_sql('tp', 'tp + fp')} AS precision
FROM (SELECT {cnt(f'score >= {dlit(C.NODE_ACCEPT)}')} AS atl, {cnt(f'score >= {dlit(C.NODE_KEEP)}')} AS tp,
             {cnt(f'score < {dlit(C.NODE_KEEP)}')} AS wtl, {cnt(f'score >= {dlit(C.NODE_ACCEPT)}')} AS fp,
             {cnt(f'score = {dlit(C.NODE_EVEN)}')} AS even, {cnt(f'score > {dlit(C.NODE_CTL)}')} AS ctl,
             {cnt(f'score < {dlit(C.NODE_WTL)}')} AS wtl_links, {cnt(f'score < {dlit(C.NODE_DTL)}')} AS dtl,
             count(*) AS pairs
      FROM node_scores)""", NODE_SCORES))


def _b(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS BIGINT)"


NODE_RUNNING = f"""
node_lines AS (
  SELECT o_id, p_id, score,
         {_b(f'score = {dlit(C.NODE_EVEN)}')} AS even, {_b(f'score > {dlit(C.NODE_CTL)}')} AS ctl,
         {_b(f'score < {dlit(C.NODE_WTL)}')} AS wtl_links, {_b(f'score < {dlit(C.NODE_DTL)}')} AS dtl,
         CAST(sum({_b(f'score >= {dlit(C.NODE_ACCEPT)}')}) OVER w AS BIGINT) AS atl_run,
         CAST(sum({_b(f'score >= {dlit(C.NODE_KEEP)}')}) OVER w AS BIGINT) AS tp_run,
         CAST(sum({_b(f'score < {dlit(C.NODE_KEEP)}')}) OVER w AS BIGINT) AS wtl_run
  FROM node_scores WINDOW w AS (ORDER BY o_id, p_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
node_run AS (
  SELECT o_id, p_id, score, atl_run, tp_run, wtl_run, atl_run AS fp_run,
         (CAST(dtl AS DOUBLE) + (CAST(even AS DOUBLE) + {dlit(C.NODE_ABOVE_OVERRIDE)}))
           + CAST(ctl + wtl_links AS DOUBLE) AS rtl,
         CAST(dtl AS DOUBLE) + (CAST(even AS DOUBLE) + {dlit(C.NODE_ABOVE_OVERRIDE)}) AS gtl,
         CAST(ctl + wtl_links AS DOUBLE) AS btl
  FROM node_lines),
node_verdicts AS (
  SELECT o_id, p_id, score, atl_run, tp_run, wtl_run, fp_run, rtl,
         {link_stats_sql('atl_run', 'wtl_run', 'gtl', 'btl', 'rtl')},
         {pct_sql('tp_run', 'tp_run + fp_run')} AS precision,
         CASE WHEN tp_run > 0 THEN {dlit(100.0)} END AS recall
  FROM node_run)
"""
VERDICT = (f"CASE WHEN p_id IS NULL THEN 'Node number not found or not a valid integer' "
           f"WHEN precision > {dlit(C.VERDICT_PRECISION)} THEN 'Node ' || CAST(p_id AS VARCHAR) || ': has been successfully attacked' "
           f"ELSE 'Node ' || CAST(p_id AS VARCHAR) || ': was unsuccessfully attacked' END")
oracle("q_node_traceability_running", with_ctes(
    f"SELECT *, {VERDICT} AS verdict FROM node_verdicts", NODE_SCORES, NODE_RUNNING))
oracle("q_node_verdict", with_ctes(
    f"SELECT o_id, p_id, precision, {VERDICT} AS verdict FROM node_verdicts", NODE_SCORES, NODE_RUNNING))

GRAPH_ROWS = f"""
strict AS (
  SELECT o.id AS o_id, p.id AS p_id,
         CASE WHEN p.id IS NULL THEN NULL ELSE {score_sql(strict_points_sql())} END AS score
  FROM o_nodes o LEFT JOIN p_nodes p ON o.id = p.id),
graph_rows AS (
  SELECT s.o_id, s.p_id, s.score,
         {_b(f's.score >= {dlit(C.GRAPH_ACCEPT)}')} AS atl,
         {_b(f's.score < {dlit(C.GRAPH_WRONG)}')} AS wtl,
         {_b(f'pr.id IS NULL AND coalesce(s.score, 0) >= {dlit(C.GRAPH_DISCARD_CTL)}')} AS ctl,
         {_b(f'pr.id IS NULL AND coalesce(s.score, 0) < {dlit(C.GRAPH_DISCARD_NONE)}')} AS dtl
  FROM strict s LEFT JOIN present pr ON pr.id = s.o_id),
counters AS (
  SELECT CAST(sum(atl) AS BIGINT) AS atl, CAST(sum(atl) AS BIGINT) AS tp,
         CAST(sum(wtl) AS BIGINT) AS wtl, CAST(sum(wtl) AS BIGINT) AS fp,
         CAST(sum(ctl) AS BIGINT) AS ctl, CAST(sum(ctl) AS BIGINT) AS fn,
         CAST(sum(dtl) AS BIGINT) AS dtl, CAST(0 AS BIGINT) AS tn
  FROM graph_rows)
"""
oracle("q_graph_counters", with_ctes("SELECT * FROM counters", PRESENT, GRAPH_ROWS))
oracle("q_precision_recall", with_ctes(
    f"SELECT tp, fp, fn, {pct_sql('tp', 'tp + fp')} AS precision, {pct_sql('tp', 'tp + fn')} AS recall FROM counters",
    PRESENT, GRAPH_ROWS))
_F1 = (f"CASE WHEN (CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END) "
       f"+ (CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END) = 0 THEN {dlit(0.0)} "
       f"ELSE {dlit(2.0)} * ((CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END) "
       f"* (CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END)) "
       f"/ ((CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END) "
       f"+ (CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END)) END")
oracle("q_f1", with_ctes(
    f"SELECT tp, fp, fn, tn, {_F1} AS f1, CASE WHEN tn + fp <> 0 THEN CAST(tn AS DOUBLE) / (tn + fp) END AS specificity "
    "FROM counters", PRESENT, GRAPH_ROWS))

oracle("q_pair_report", with_ctes(f"""
SELECT o_id, p_id, score AS similarity, c_atl AS atl, c_ctl AS ctl, c_dtl AS dtl, c_wtl AS wtl,
       c_dtl + c_atl + c_ctl + c_wtl AS rtl,
       {link_stats_sql('c_atl', 'c_wtl', 'c_dtl + c_atl', 'c_ctl + c_wtl', 'c_dtl + c_atl + c_ctl + c_wtl')},
       CASE WHEN c_atl + c_wtl <> 0 THEN CAST(c_atl AS DOUBLE) / CAST(c_atl + c_wtl AS DOUBLE) * {dlit(100.0)} END AS precision,
       CASE WHEN c_atl + c_ctl <> 0 THEN CAST(c_atl AS DOUBLE) / CAST(c_atl + c_ctl AS DOUBLE) * {dlit(100.0)} END AS recall
FROM (SELECT o_id, p_id, score,
             CAST(sum(atl) OVER w AS BIGINT) AS c_atl, CAST(sum(wtl) OVER w AS BIGINT) AS c_wtl,
             CAST(sum(ctl) OVER w AS BIGINT) AS c_ctl, CAST(sum(dtl) OVER w AS BIGINT) AS c_dtl
      FROM graph_rows WINDOW w AS (ORDER BY o_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    PRESENT, GRAPH_ROWS))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


# --- Step 4/5: walks and paths -----------------------------------------------
from ..functions.hashing import draw_sql, mix_sql  # noqa: E402

WALKS = f"""
usable AS (SELECT * FROM p_edges WHERE weight IS NOT NULL AND src <> dst),
adj AS (SELECT src AS node, dst AS nbr, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS pos FROM usable),
outdeg AS (SELECT src AS node, count(*) AS d FROM usable GROUP BY src),
start AS (SELECT coalesce((SELECT min(dst) FROM usable WHERE src = (SELECT min(src) FROM usable)),
                          (SELECT min(src) FROM usable)) AS s),
walks(walk_id, step, node_id) AS (
  SELECT CAST(range AS BIGINT), CAST(0 AS BIGINT), (SELECT s FROM start) FROM range(0, {C.N_WALKS})
  UNION ALL
  SELECT w.walk_id, w.step + 1, a.nbr
  FROM walks w JOIN outdeg d ON d.node = w.node_id
  JOIN adj a ON a.node = w.node_id AND a.pos = {mix_sql('w.walk_id', 'w.step + 1', C.SEED)} % d.d
  WHERE w.step + 1 < {C.MAX_STEPS})
"""
WALK_SUMMARY = f"""
walk_summary AS (
  SELECT l.walk_id, l.length, l.last_node, coalesce(n.valuable_data, false) AS success,
         l.length >= {C.MAX_STEPS} AND coalesce(d.d, 0) > 0 AS truncated
  FROM (SELECT walk_id, count(*) AS length, arg_max(node_id, step) AS last_node FROM walks GROUP BY walk_id) l
  LEFT JOIN p_nodes n ON n.id = l.last_node
  LEFT JOIN outdeg d ON d.node = l.last_node)
"""
oracle("q_random_walks", with_ctes("SELECT * FROM walks", WALKS, recursive=True))
oracle("q_walk_success", with_ctes("SELECT * FROM walk_summary", WALKS, WALK_SUMMARY, recursive=True))
oracle("q_honeypot_hits", with_ctes("""
SELECT w.walk_id, CAST(count(a.id) AS BIGINT) AS honeypot_steps, count(DISTINCT a.id) AS honeypots
FROM walks w LEFT JOIN (SELECT id FROM node_d WHERE change = 'Added') a ON a.id = w.node_id
GROUP BY w.walk_id""", NODE_DIFF, WALKS, recursive=True))
oracle("q_walk_stats", with_ctes("""
SELECT CAST(min(length) AS BIGINT) AS min_v, CAST(max(length) AS BIGINT) AS max_v,
       quantile_cont(CAST(length AS DOUBLE), 0.5) AS median_v, avg(CAST(length AS DOUBLE)) AS mean_v, count(*) AS n
FROM walk_summary""", WALKS, WALK_SUMMARY, recursive=True))

WALKED_BEST = f"""
walked AS (SELECT DISTINCT node_id AS id FROM walks),
walked_pairs AS (
  SELECT o.id AS o_id, p.id AS p_id, {PTS} AS pts
  FROM o_nodes o, p_nodes p WHERE p.id IN (SELECT id FROM walked)),
walked_best AS (
  SELECT p_id, arg_min(o_id, (-pts, o_id)) AS o_id, max(pts) AS pts, count(*) AS n_matches
  FROM walked_pairs WHERE pts >= {C.BEST_MATCH_MIN_POINTS} GROUP BY p_id)
"""
oracle("q_walk_pairs_scored", with_ctes(
    f"SELECT p_id, o_id, pts, round({score_sql('pts')}, 2) AS score, n_matches FROM walked_best",
    WALKS, WALKED_BEST, recursive=True))
oracle("q_attack_tally", with_ctes(f"""
SELECT w.walk_id, count(*) AS attempts,
       CAST(sum(CASE WHEN {draw_sql('w.walk_id', 'w.step', C.SEED + 1)} <= {dlit(C.ATTACK_DRAW)}
                     THEN CASE WHEN coalesce(round({score_sql('b.pts')}, 2), 0) >= {dlit(C.ATTACK_SCORE)} THEN 2 ELSE 1 END
                     ELSE 0 END) AS BIGINT) AS successful,
       CAST(count(*) FILTER (WHERE NOT ({draw_sql('w.walk_id', 'w.step', C.SEED + 1)} <= {dlit(C.ATTACK_DRAW)})) AS BIGINT) AS failed
FROM walks w LEFT JOIN walked_best b ON b.p_id = w.node_id
WHERE w.step > 0 GROUP BY w.walk_id""", WALKS, WALKED_BEST, recursive=True))

BFS_VALUABLE = f"""
und AS (SELECT src AS node, dst AS nbr FROM p_edges UNION SELECT dst, src FROM p_edges),
bfs(node, d) USING KEY (node) AS (
  SELECT id, CAST(0 AS BIGINT) FROM p_nodes WHERE valuable_data
  UNION
  SELECT u.nbr, min(b.d) + 1 FROM bfs b JOIN und u ON u.node = b.node
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs r WHERE r.node = u.nbr) GROUP BY u.nbr),
par AS (
  SELECT b.node, min(u.nbr) AS parent FROM bfs b JOIN und u ON u.node = b.node
  JOIN bfs b2 ON b2.node = u.nbr AND b2.d = b.d - 1 WHERE b.d > 0 GROUP BY b.node),
chain(start, cur, path, k) AS (
  SELECT node, node, CAST(node AS VARCHAR), 0 FROM bfs
  UNION ALL
  SELECT c.start, p.parent, c.path || ',' || CAST(p.parent AS VARCHAR), c.k + 1
  FROM chain c JOIN par p ON p.node = c.cur),
ends AS (SELECT start, arg_max(cur, k) AS target, arg_max(path, k) AS path FROM chain GROUP BY start),
nearest AS (
  SELECT n.id, coalesce(b.d, {C.UNREACHABLE}) AS hops, e.target,
         CAST(b.d AS DOUBLE) * n.stored_value AS distance, coalesce(e.path, '') AS path
  FROM p_nodes n LEFT JOIN bfs b ON b.node = n.id LEFT JOIN ends e ON e.start = n.id)
"""
oracle("q_nearest_valuable", with_ctes("SELECT id, hops, target, distance FROM nearest", BFS_VALUABLE, recursive=True))
oracle("q_path_to_valuable", with_ctes("""
SELECT id, path, CAST(CASE WHEN path = '' THEN 0 ELSE len(string_split(path, ',')) END AS BIGINT) AS path_nodes
FROM nearest""", BFS_VALUABLE, recursive=True))
oracle("q_nearest_valuable_weighted", with_ctes("""
SELECT n.id, b.t AS target, b.d AS distance FROM p_nodes n LEFT JOIN far b ON b.node = n.id""", """
ways AS (SELECT node, nbr, min(weight) AS w
         FROM (SELECT src AS node, dst AS nbr, weight FROM p_edges UNION ALL SELECT dst, src, weight FROM p_edges)
         WHERE weight IS NOT NULL AND node <> nbr GROUP BY node, nbr),
far(node, d, t) USING KEY (node) AS (
  SELECT id, CAST(0 AS DOUBLE), id FROM p_nodes WHERE valuable_data
  UNION
  SELECT node, o.d, o.t
  FROM (SELECT u.nbr AS node, min({'d': b.d + u.w, 't': b.t}) AS o
        FROM far b JOIN ways u ON u.node = b.node GROUP BY u.nbr) x
  LEFT JOIN recurring.far r USING (node)
  WHERE r.d IS NULL OR o.d < r.d OR (o.d = r.d AND o.t < r.t))
""", recursive=True))
oracle("q_sssp_hops", with_ctes("""
SELECT node, d AS hops FROM bfs1""", """
und AS (SELECT src AS node, dst AS nbr FROM p_edges UNION SELECT dst, src FROM p_edges),
start AS (SELECT coalesce((SELECT min(dst) FROM p_edges WHERE src = (SELECT min(src) FROM p_edges)),
                          (SELECT min(src) FROM p_edges)) AS s),
bfs1(node, d) USING KEY (node) AS (
  SELECT s, CAST(0 AS BIGINT) FROM start
  UNION
  SELECT u.nbr, min(b.d) + 1 FROM bfs1 b JOIN und u ON u.node = b.node
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bfs1 r WHERE r.node = u.nbr) GROUP BY u.nbr)
""", recursive=True))


# --- Step 6: move log ----------------------------------------------------------

ROUNDS = """
mv AS (
  SELECT *, CAST(sum(CASE WHEN lower("user") = 'restart' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY game_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              - CASE WHEN lower("user") = 'restart' THEN 1 ELSE 0 END AS BIGINT) AS round
  FROM moves),
mvr AS (SELECT *, row_number() OVER (PARTITION BY game_id, round ORDER BY seq) AS rn FROM mv)
"""
BOARD_FACTS = """
bfacts AS (
  SELECT n.id AS node, n.valuable_data AS valuable, coalesce(od.c, 0) = 0 AS sink
  FROM board_nodes n LEFT JOIN (SELECT src, count(*) AS c FROM board_edges GROUP BY src) od ON od.src = n.id),
bund AS (SELECT src AS a, dst AS b FROM board_edges UNION SELECT dst, src FROM board_edges)
"""
PLACE = f"""
starts AS (
  SELECT game_id, round, (game_id*7 + round*3 + 1) % {C.BOARD_SIZE} AS thief_start,
         (game_id*11 + round*5 + 5) % {C.BOARD_SIZE} AS police_start
  FROM (SELECT DISTINCT game_id, round FROM mv)),
place AS (
  SELECT s.game_id, s.round, s.thief_start, s.police_start,
         CASE WHEN t.valuable THEN 'thief_wins' WHEN t.sink THEN 'thief_no_moves'
              WHEN p.sink THEN 'policeman_no_moves' WHEN s.thief_start = s.police_start THEN 'policeman_wins' END AS placement_verdict
  FROM starts s LEFT JOIN bfacts t ON t.node = s.thief_start LEFT JOIN bfacts p ON p.node = s.police_start)
"""
_V = "('thief_wins', 'policeman_wins', 'thief_no_moves', 'policeman_no_moves', 'thief_illegal', 'policeman_illegal')"


def _replay(illegal_loses: bool) -> str:
    """The fold, one move a step; ``illegal_loses`` looks the move up in the rewired board too."""
    own_turn_in_p = "padj AND u = turn" if illegal_loses else "false"
    p_board = "SELECT src AS a, dst AS b FROM board_rewired UNION SELECT dst, src FROM board_rewired" if illegal_loses \
        else "SELECT a, b FROM bund WHERE false"
    return f"""
rund AS ({p_board}),
rep(game_id, round, k, seq, t, p, turn, verdict, status) AS (
  SELECT game_id, round, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), thief_start, police_start,
         'thief', placement_verdict, CAST(NULL AS VARCHAR)
  FROM place
  UNION ALL
  SELECT game_id, round, k, seq,
         CASE WHEN moved AND is_thief THEN target ELSE t END,
         CASE WHEN moved AND NOT is_thief THEN target ELSE p END,
         CASE WHEN status = 'accepted' THEN CASE WHEN is_thief THEN 'policeman' ELSE 'thief' END ELSE turn END,
         CASE WHEN verdict IS NULL AND status IN {_V} THEN status ELSE verdict END,
         status
  FROM (
    SELECT *,
      CASE WHEN u = 'restart' THEN 'restart'
           WHEN verdict IS NOT NULL THEN 'game_over'
           WHEN u NOT IN ('thief', 'policeman') THEN 'invalid_user'
           WHEN u = 'policeman' AND p = t THEN 'policeman_wins'
           WHEN NOT adj THEN CASE WHEN {own_turn_in_p} THEN u || '_illegal' ELSE 'invalid_move' END
           WHEN u <> turn THEN 'wrong_turn'
           WHEN is_thief AND valuable THEN 'thief_wins'
           WHEN is_thief AND sink THEN 'thief_no_moves'
           WHEN NOT is_thief AND target = t THEN 'policeman_wins'
           WHEN NOT is_thief AND sink THEN 'policeman_no_moves'
           ELSE 'accepted' END AS status,
      verdict IS NULL AND u IN ('thief', 'policeman') AND NOT (u = 'policeman' AND p = t) AND adj AND u = turn AS moved
    FROM (
      SELECT r.game_id, r.round, r.k + 1 AS k, m.seq, r.t, r.p, r.turn, r.verdict,
             lower(m."user") AS u, lower(m."user") = 'thief' AS is_thief, m.target,
             coalesce(f.valuable, false) AS valuable, coalesce(f.sink, false) AS sink,
             b.a IS NOT NULL AS adj, pb.a IS NOT NULL AS padj
      FROM rep r
      JOIN mvr m ON m.game_id = r.game_id AND m.round = r.round AND m.rn = r.k + 1
      LEFT JOIN bfacts f ON f.node = m.target
      LEFT JOIN bund b ON b.a = CASE WHEN lower(m."user") = 'thief' THEN r.t ELSE r.p END AND b.b = m.target
      LEFT JOIN rund pb ON pb.a = CASE WHEN lower(m."user") = 'thief' THEN r.t ELSE r.p END AND pb.b = m.target)))
"""


REPLAY = _replay(False)
REPLAY_ILLEGAL = _replay(True)
OUTCOMES = """
outcomes AS (
  SELECT pl.game_id, pl.round, pl.thief_start, pl.police_start, pl.placement_verdict,
         coalesce(l.verdict, pl.placement_verdict, 'open') AS outcome,
         CASE WHEN pl.placement_verdict IS NOT NULL THEN 'placement'
              WHEN l.verdict IS NOT NULL THEN 'play' END AS decided_at,
         coalesce(l.t, pl.thief_start) AS thief_node, coalesce(l.p, pl.police_start) AS police_node,
         coalesce(l.k, 0) AS n_moves
  FROM place pl
  LEFT JOIN (SELECT game_id, round, arg_max(verdict, k) AS verdict, arg_max(t, k) AS t, arg_max(p, k) AS p,
                    max(k) AS k
             FROM rep GROUP BY game_id, round) l
    ON l.game_id = pl.game_id AND l.round = pl.round),
latest AS (
  SELECT o.game_id, 'thief' AS role, o.thief_node AS node FROM outcomes o
  JOIN (SELECT game_id, max(round) AS round FROM outcomes GROUP BY game_id) x ON x.game_id = o.game_id AND x.round = o.round
  UNION ALL
  SELECT o.game_id, 'policeman', o.police_node FROM outcomes o
  JOIN (SELECT game_id, max(round) AS round FROM outcomes GROUP BY game_id) x ON x.game_id = o.game_id AND x.round = o.round)
"""
_MOVES = dict(graph=False, moves=True)
oracle("q_start_positions", with_ctes("SELECT game_id, round, thief_start, police_start FROM starts",
                                      ROUNDS, PLACE, **_MOVES))
oracle("q_initial_verdict", with_ctes("SELECT * FROM place", ROUNDS, BOARD_FACTS, PLACE, **_MOVES))
oracle("q_rounds", with_ctes("SELECT game_id, seq, round FROM mv", ROUNDS, **_MOVES))
oracle("q_turn_audit", with_ctes("""
SELECT m.game_id, m.seq, lower(m."user") AS "user", lower(p."user") AS prev_user,
       coalesce(lower(m."user") = lower(p."user"), false) AS repeated
FROM moves m LEFT JOIN moves p ON p.game_id = m.game_id AND p.seq = m.seq - 1""", **_MOVES))
oracle("q_replay_moves", with_ctes("""
SELECT r.game_id, r.seq, r.round, m."user", m.target, r.status, r.t AS thief_node, r.p AS police_node
FROM rep r JOIN mv m ON m.game_id = r.game_id AND m.seq = r.seq WHERE r.k > 0""",
    ROUNDS, BOARD_FACTS, PLACE, REPLAY, recursive=True, **_MOVES))
oracle("q_replay_illegal_loses", with_ctes("""
SELECT r.game_id, r.seq, r.round, m."user", m.target, r.status, r.t AS thief_node, r.p AS police_node
FROM rep r JOIN mv m ON m.game_id = r.game_id AND m.seq = r.seq WHERE r.k > 0""",
    ROUNDS, BOARD_FACTS, PLACE, REPLAY_ILLEGAL, recursive=True, **_MOVES))
oracle("q_outcomes_illegal_loses", with_ctes("SELECT * FROM outcomes",
                                             ROUNDS, BOARD_FACTS, PLACE, REPLAY_ILLEGAL, OUTCOMES, recursive=True, **_MOVES))
oracle("q_game_outcomes", with_ctes("SELECT * FROM outcomes",
                                    ROUNDS, BOARD_FACTS, PLACE, REPLAY, OUTCOMES, recursive=True, **_MOVES))
oracle("q_latest_positions", with_ctes("SELECT * FROM latest",
                                       ROUNDS, BOARD_FACTS, PLACE, REPLAY, OUTCOMES, recursive=True, **_MOVES))

_NODE_TXT = ("'NodeObject(' || concat_ws(',', n.id, n.children, n.props, n.current_depth, n.prop_value_range, "
             "n.max_depth, n.max_branching_factor, n.max_properties, CAST(n.stored_value AS VARCHAR), "
             "CAST(n.valuable_data AS VARCHAR)) || ')'")
STATUS = f"""
bpund AS (SELECT src AS node, dst AS nbr FROM board_p_edges UNION SELECT dst, src FROM board_p_edges),
bbfs(node, d) USING KEY (node) AS (
  SELECT id, CAST(0 AS BIGINT) FROM board_nodes WHERE valuable_data
  UNION
  SELECT u.nbr, min(b.d) + 1 FROM bbfs b JOIN bpund u ON u.node = b.node
  WHERE NOT EXISTS (SELECT 1 FROM recurring.bbfs r WHERE r.node = u.nbr) GROUP BY u.nbr),
bpar AS (
  SELECT b.node, min(u.nbr) AS parent FROM bbfs b JOIN bpund u ON u.node = b.node
  JOIN bbfs b2 ON b2.node = u.nbr AND b2.d = b.d - 1 WHERE b.d > 0 GROUP BY b.node),
bchain(start, cur, path, k) AS (
  SELECT node, node, CAST(node AS VARCHAR), 0 FROM bbfs
  UNION ALL
  SELECT c.start, p.parent, c.path || ',' || CAST(p.parent AS VARCHAR), c.k + 1 FROM bchain c JOIN bpar p ON p.node = c.cur),
bpath AS (SELECT start AS node, arg_max(path, k) AS path FROM bchain GROUP BY start),
bdeg_o AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM board_edges UNION ALL SELECT dst FROM board_edges) GROUP BY node),
bdeg_p AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM board_p_edges UNION ALL SELECT dst FROM board_p_edges) GROUP BY node),
bshared AS (SELECT o.src, o.dst FROM board_edges o JOIN board_p_edges p ON o.src = p.src AND o.dst = p.dst),
bshared_deg AS (SELECT node, count(*) AS c FROM (SELECT src AS node FROM bshared UNION ALL SELECT dst FROM bshared) GROUP BY node),
bconf AS (
  SELECT n.id AS node,
         CASE WHEN coalesce(a.c, 0) = 0 THEN CAST(0 AS DOUBLE)
              ELSE least(CAST(1 AS DOUBLE), CAST(1 + CASE WHEN coalesce(a.c, 0) = coalesce(b.c, 0) THEN coalesce(m.c, 0) ELSE 0 END AS DOUBLE)
                         / CAST(a.c AS DOUBLE)) END AS confidence
  FROM board_nodes n LEFT JOIN bdeg_o a ON a.node = n.id LEFT JOIN bdeg_p b ON b.node = n.id
  LEFT JOIN bshared_deg m ON m.node = n.id),
badj AS (SELECT a AS node, string_agg(CAST(b AS VARCHAR), ',' ORDER BY b) AS adjacent FROM bund GROUP BY a),
nmoves AS (SELECT game_id, lower("user") AS role, count(*) AS n_moves FROM moves GROUP BY game_id, lower("user")),
thief_sv AS (SELECT l.game_id, n.stored_value AS thief_sv FROM latest l JOIN board_nodes n ON n.id = l.node WHERE l.role = 'thief'),
status AS (
  SELECT l.game_id, l.role, l.node, coalesce(a.adjacent, '') AS adjacent,
         coalesce(b.d, {C.UNREACHABLE}) AS hops,
         CASE WHEN b.d IS NOT NULL THEN CAST(b.d AS DOUBLE) * ts.thief_sv END AS distance,
         coalesce(bp.path, '') AS path, coalesce(c.confidence, CAST(0 AS DOUBLE)) AS confidence,
         coalesce(nm.n_moves, 0) AS n_moves
  FROM latest l
  LEFT JOIN badj a ON a.node = l.node LEFT JOIN bbfs b ON b.node = l.node LEFT JOIN bpath bp ON bp.node = l.node
  LEFT JOIN bconf c ON c.node = l.node LEFT JOIN nmoves nm ON nm.game_id = l.game_id AND nm.role = l.role
  LEFT JOIN thief_sv ts ON ts.game_id = l.game_id)
"""
_ALL_STATUS = (ROUNDS, BOARD_FACTS, PLACE, REPLAY, OUTCOMES, STATUS)
oracle("q_player_status", with_ctes("SELECT * FROM status", *_ALL_STATUS, recursive=True, **_MOVES))
oracle("q_opponent_view", with_ctes("""
SELECT s.game_id, s.role, o.node AS opponent_node, o.adjacent AS opponent_adjacent
FROM status s JOIN status o ON o.game_id = s.game_id AND o.role <> s.role""", *_ALL_STATUS, recursive=True, **_MOVES))
oracle("q_report_lines", with_ctes(f"""
SELECT s.game_id, s.role, CAST(1 AS BIGINT) AS section, CAST(x.ord - 1 AS BIGINT) AS ord,
       'Path to Valuable Node: ' || {_NODE_TXT} AS line
FROM status s, unnest(string_split(s.path, ',')) WITH ORDINALITY AS x(pid, ord)
JOIN board_nodes n ON n.id = TRY_CAST(x.pid AS BIGINT)
WHERE s.path <> ''
UNION ALL
SELECT game_id, role, 2, 0, 'Confidence Score: ' || CAST(confidence AS VARCHAR) FROM status
UNION ALL
SELECT s.game_id, s.role, 3, b.b, 'Adjacent Node: ' || {_NODE_TXT}
FROM status s JOIN bund b ON b.a = s.node JOIN board_nodes n ON n.id = b.b
UNION ALL
SELECT s.game_id, s.role, 4, m.seq, 'Move: Move(' || m."user" || ',' || {_NODE_TXT} || ')'
FROM status s JOIN moves m ON m.game_id = s.game_id AND lower(m."user") = s.role JOIN board_nodes n ON n.id = m.target
UNION ALL
SELECT game_id, role, 5, 0, 'Distance to Valuable Node: ' || coalesce(CAST(distance AS VARCHAR), '-') FROM status
""", *_ALL_STATUS, recursive=True, **_MOVES))


# --- Step 9: sources and sinks -----------------------------------------------

oracle("q_dot_roundtrip", with_ctes("SELECT src, dst, weight FROM p_edges"))
oracle("q_report_roundtrip", with_ctes("""
SELECT 'Nodes' AS entity, change, id AS a, CAST(NULL AS BIGINT) AS b FROM node_d WHERE change IN ('Modified', 'Removed')
UNION ALL
SELECT 'Nodes', 'Added', coalesce((SELECT min(src) FROM p_edges e WHERE e.dst = n.id), -1), n.id
FROM node_d n WHERE change = 'Added'
UNION ALL
SELECT 'Edges', change, src, dst FROM edge_d WHERE change <> 'Same'""", NODE_DIFF, EDGE_DIFF))
oracle("q_shards", with_ctes(f"""
SELECT src, dst, weight, (rn - 1) // {C.SHARD_SIZE} AS shard_id, (rn - 1) % {C.SHARD_SIZE} AS row_in_shard
FROM (SELECT *, row_number() OVER (ORDER BY src, dst) AS rn FROM p_edges)"""))
oracle("q_extract_formatted", with_ctes(f"""
SELECT 'node' AS kind, (rn - 1) // {C.EXTRACT_GROUP} AS group_id, (rn - 1) % {C.EXTRACT_GROUP} AS pos,
       concat_ws(',', id, children, props, current_depth, prop_value_range, max_depth, max_branching_factor,
                 max_properties, printf('%.3f', stored_value), CAST(valuable_data AS VARCHAR)) AS line
FROM (SELECT *, row_number() OVER (ORDER BY id) AS rn FROM p_nodes)
UNION ALL
SELECT 'edge', (rn - 1) // {C.EXTRACT_GROUP}, (rn - 1) % {C.EXTRACT_GROUP},
       concat_ws(',', src, dst, CASE WHEN cost IS NULL THEN '-' ELSE printf('%.3f', cost) END)
FROM (SELECT p.src, p.dst, o.weight AS cost, row_number() OVER (ORDER BY p.src, p.dst) AS rn
      FROM p_edges p LEFT JOIN o_edges o ON o.src = p.src AND o.dst = p.dst)"""))

oracle("q_moves_per_window", with_ctes(f"""
SELECT CAST(epoch(time_bucket(INTERVAL {C.WINDOW_MINUTES} MINUTES, ts)) AS BIGINT) AS window_start,
       lower("user") AS "user", count(*) AS n
FROM moves GROUP BY ALL""", graph=False, moves=True))

_F1_RUN = (f"CASE WHEN tp_run + fp_run = 0 THEN NULL ELSE {dlit(2.0)} * ((CAST(tp_run AS DOUBLE) / (tp_run + fp_run)) "
           f"* (CASE WHEN tp_run <> 0 THEN CAST(tp_run AS DOUBLE) / tp_run END)) / "
           f"((CAST(tp_run AS DOUBLE) / (tp_run + fp_run)) + (CASE WHEN tp_run <> 0 THEN CAST(tp_run AS DOUBLE) / tp_run END)) END")
oracle("q_score_text", with_ctes(f"""
SELECT o_id, p_id,
       {VERDICT} || ' \nPrecision: ' || coalesce(CAST(precision AS VARCHAR), 'NaN')
       || '\nRecall: ' || coalesce(CAST(recall AS VARCHAR), 'NaN')
       || '\nF1-Score: ' || coalesce(CAST(
            CASE WHEN (CASE WHEN tp_run + fp_run <> 0 THEN CAST(tp_run AS DOUBLE) / (tp_run + fp_run) END)
                    + (CASE WHEN tp_run <> 0 THEN CAST(tp_run AS DOUBLE) / tp_run END) = 0 THEN {dlit(0.0)}
                 ELSE {dlit(2.0)} * ((CASE WHEN tp_run + fp_run <> 0 THEN CAST(tp_run AS DOUBLE) / (tp_run + fp_run) END)
                      * (CASE WHEN tp_run <> 0 THEN CAST(tp_run AS DOUBLE) / tp_run END))
                      / ((CASE WHEN tp_run + fp_run <> 0 THEN CAST(tp_run AS DOUBLE) / (tp_run + fp_run) END)
                      + (CASE WHEN tp_run <> 0 THEN CAST(tp_run AS DOUBLE) / tp_run END)) END AS VARCHAR), 'NaN') AS text
FROM node_verdicts""", NODE_SCORES, NODE_RUNNING))

# --- Further operators ----------------------------------------------------------

oracle("q_adjacency_dense", with_ctes("""
SELECT a.id AS node, string_agg(CASE WHEN e.weight IS NULL THEN '-' ELSE printf('%.3f', e.weight) END, ',' ORDER BY b.id) AS costs
FROM sub a CROSS JOIN sub b LEFT JOIN p_edges e ON e.src = a.id AND e.dst = b.id GROUP BY a.id""", """
start AS (SELECT coalesce((SELECT min(dst) FROM p_edges WHERE src = (SELECT min(src) FROM p_edges)),
                          (SELECT min(src) FROM p_edges)) AS s),
sub AS (SELECT s AS id FROM start UNION SELECT dst FROM p_edges JOIN start ON src = s)"""))
oracle("q_has_edge", with_ctes("SELECT o.src, o.dst FROM o_edges o JOIN p_edges p ON o.src = p.src AND o.dst = p.dst"))
oracle("q_reconcile", with_ctes("""
SELECT 'Nodes' AS entity, change, id AS a, CAST(NULL AS BIGINT) AS b, true AS in_diff, change <> 'Modified' AS in_report
FROM node_d WHERE change IN ('Modified', 'Removed')
UNION ALL
SELECT 'Nodes', 'Added', coalesce((SELECT min(src) FROM p_edges e WHERE e.dst = n.id), -1), n.id, true, true
FROM node_d n WHERE change = 'Added'
UNION ALL
SELECT 'Edges', change, src, dst, true, change <> 'Modified' FROM edge_d WHERE change <> 'Same'
UNION ALL
SELECT 'Edges', 'Added', src, dst, false, true FROM edge_d WHERE change = 'Removed'""", NODE_DIFF, EDGE_DIFF))
oracle("q_best_match_top3", with_ctes(f"""
SELECT p_id, o_id, pts, round({score_sql('pts')}, 2) AS score, rank
FROM (SELECT *, row_number() OVER (PARTITION BY p_id ORDER BY pts DESC, o_id) AS rank
      FROM (SELECT o.id AS o_id, p.id AS p_id, {PTS} AS pts FROM o_nodes o, p_nodes p) WHERE pts >= {C.BEST_MATCH_MIN_POINTS})
WHERE rank <= 3"""))
oracle("q_walk_node_stats", with_ctes("""
SELECT CAST(min(node_id) AS BIGINT) AS min_v, CAST(max(node_id) AS BIGINT) AS max_v,
       quantile_cont(CAST(node_id AS DOUBLE), 0.5) AS median_v, avg(CAST(node_id AS DOUBLE)) AS mean_v, count(*) AS n
FROM walks WHERE step > 0""", WALKS, recursive=True))
oracle("q_pair_text", with_ctes(
    "SELECT " + ", ".join(f"{s}.{c} AS {s}_{c}" for s in ("o", "p") for c in ["id", *NODE_PROPS])
    + " FROM o_nodes o JOIN p_nodes p ON o.id = p.id"))
oracle("q_moves_json", with_ctes("""
SELECT m.game_id, m.seq, m."user", n.* FROM moves m JOIN board_nodes n ON n.id = m.target""", **_MOVES))
oracle("q_status_of_users", with_ctes(f"""
SELECT u.game_id, u.role, s.node, coalesce(s.adjacent, '') AS adjacent, coalesce(s.hops, {C.UNREACHABLE}) AS hops,
       s.distance, coalesce(s.path, '') AS path, coalesce(s.confidence, CAST(0 AS DOUBLE)) AS confidence,
       coalesce(s.n_moves, 0) AS n_moves
FROM (SELECT DISTINCT game_id, lower("user") AS role FROM moves) u
LEFT JOIN status s ON s.game_id = u.game_id AND s.role = u.role""", *_ALL_STATUS, recursive=True, **_MOVES))
oracle("q_graph_counters_triangular", with_ctes("""
SELECT CAST(sum(atl * k) AS BIGINT) AS atl, CAST(sum(atl * k) AS BIGINT) AS tp,
       CAST(sum(wtl * k) AS BIGINT) AS wtl, CAST(sum(wtl * k) AS BIGINT) AS fp,
       CAST(sum(ctl * k) AS BIGINT) AS ctl, CAST(sum(ctl * k) AS BIGINT) AS fn,
       CAST(sum(dtl * k) AS BIGINT) AS dtl, CAST(0 AS BIGINT) AS tn
FROM (SELECT *, row_number() OVER (ORDER BY o_id, p_id) AS k FROM graph_rows)""", PRESENT, GRAPH_ROWS))
oracle("q_contained_nodes", with_ctes("SELECT id FROM o_nodes WHERE id IN (SELECT id FROM p_nodes)"))
oracle("q_adjacency_tiles", with_ctes("""
SELECT a.id AS node, a.i AS row, b.i // 16 AS col_tile,
       string_agg(CASE WHEN e.weight IS NULL THEN '-' ELSE printf('%.3f', e.weight) END, ',' ORDER BY b.i) AS costs
FROM sub a CROSS JOIN sub b LEFT JOIN p_edges e ON e.src = a.id AND e.dst = b.id GROUP BY a.id, a.i, b.i // 16""", """
start AS (SELECT coalesce((SELECT min(dst) FROM p_edges WHERE src = (SELECT min(src) FROM p_edges)),
                          (SELECT min(src) FROM p_edges)) AS s),
sub AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i FROM (SELECT s AS id FROM start UNION SELECT dst FROM p_edges JOIN start ON src = s))"""))
oracle("q_shards_roundtrip", with_ctes(f"""
SELECT (row_number() OVER (ORDER BY src, dst) - 1) // {C.SHARD_SIZE} AS shard_id, src, dst, weight FROM p_edges"""))
oracle("q_status_documents", with_ctes(f"""
SELECT s.game_id, s.role, coalesce(m.part, 0) AS part, coalesce(m.moves, '') AS moves, s.adjacent,
       coalesce(s.distance, CAST({C.UNREACHABLE} AS DOUBLE)) AS distance, s.path, s.confidence
FROM status s LEFT JOIN (
  SELECT game_id, role, part, string_agg(u || ':' || CAST(target AS VARCHAR), ',' ORDER BY seq) AS moves
  FROM (SELECT game_id, lower("user") AS role, "user" AS u, target, seq,
               (row_number() OVER (PARTITION BY game_id, lower("user") ORDER BY seq) - 1) // 20 AS part FROM moves)
  GROUP BY game_id, role, part) m ON m.game_id = s.game_id AND m.role = s.role""", *_ALL_STATUS, recursive=True, **_MOVES))
oracle("q_graph_files", with_ctes("""
SELECT e.src, e.dst, e.weight, a.stored_value AS src_value, b.stored_value AS dst_value
FROM p_edges e LEFT JOIN p_nodes a ON a.id = e.src LEFT JOIN p_nodes b ON b.id = e.dst"""))
oracle("q_node_csv", with_ctes(_NODE_VALUES + " FROM p_nodes"))
oracle("q_pair_text_header", with_ctes(
    "SELECT " + ", ".join(f"{s}.{c} AS {s}_{c}" for s in ("o", "p") for c in ["id", *NODE_PROPS])
    + " FROM o_nodes o JOIN p_nodes p ON o.id = p.id"))
oracle("q_walk_text", with_ctes("SELECT concat_ws(',', walk_id, step, node_id) AS value FROM walks", WALKS, recursive=True))
oracle("q_score_lines", with_ctes("SELECT concat_ws(',', src, dst, CAST(score AS VARCHAR)) AS value FROM edge_scores", EDGE_PAIRS, EDGE_SCORES))
_LINES = oracle_sql()["q_report_lines"]
_CUT = _LINES.rindex("SELECT s.game_id, s.role, CAST(1 AS BIGINT) AS section")
oracle("q_report_text", _LINES[:_CUT] + "SELECT line AS value FROM (" + _LINES[_CUT:] + ")")
oracle("q_status_json", with_ctes("SELECT * FROM status", *_ALL_STATUS, recursive=True, **_MOVES))
oracle("q_score_jitter", with_ctes(f"""
SELECT o_id, p_id, round(round({score_sql('pts')}, 2) + {draw_sql('o_id', 'p_id', C.SEED)} * {dlit(0.2)} - {dlit(0.1)}, 9) AS score
FROM (SELECT o.id AS o_id, p.id AS p_id, {PTS} AS pts FROM o_nodes o JOIN p_nodes p ON o.id = p.id)"""))
oracle("q_stream_replay", oracle_sql()["q_replay_moves"])
