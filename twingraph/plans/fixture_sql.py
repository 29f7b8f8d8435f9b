"""The fixture derivation of :mod:`twingraph.fixtures` as SQL CTE text.

Used by the oracle queries (DuckDB dialect; driver tables are views).
Integer arithmetic is BIGINT, divisions are DOUBLE, literals are cast.
"""

from __future__ import annotations

from .. import constants as C

D = "CAST({} AS DOUBLE)".format

GRAPH_CTES = f"""
o_nodes AS (
  SELECT p_partkey AS id,
         (p_partkey*5+1) % 7 AS children,
         (p_partkey*11+3) % 20 AS props,
         CAST(CASE WHEN p_partkey % 50 = 0 THEN 2 ELSE 1 END AS BIGINT) AS current_depth,
         CAST(p_size AS BIGINT)*2-1 AS prop_value_range,
         (p_partkey*3) % 5 AS max_depth,
         (p_partkey*13+2) % 7 AS max_branching_factor,
         (p_partkey*17+5) % 20 AS max_properties,
         CAST((p_partkey*7919) % 100003 AS DOUBLE) / {D(100003)} AS stored_value,
         p_partkey % 97 = 13 AS valuable_data
  FROM part),
li_raw AS (
  SELECT l_partkey AS src,
         lead(l_partkey) OVER (PARTITION BY l_orderkey
                               ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS dst,
         CAST(l_quantity AS BIGINT) % 9 + 1 AS w
  FROM lineitem),
o_edges AS (
  SELECT src, dst, CASE WHEN (src*31+dst) % 50 <> 7 THEN CAST(min(w) AS DOUBLE) END AS weight
  FROM li_raw WHERE dst IS NOT NULL GROUP BY src, dst),
n_parts AS (SELECT max(p_partkey) + 1 AS n FROM part),
p_nodes AS (
  SELECT id, children,
         CASE WHEN id % 20 = 7 THEN (props+9) % 20 ELSE props END AS props,
         current_depth, prop_value_range, max_depth,
         CASE WHEN id % 20 = 7 THEN max_branching_factor+20 ELSE max_branching_factor END AS max_branching_factor,
         max_properties,
         CASE WHEN id % 20 = 7 THEN stored_value * {D(0.5)} ELSE stored_value END AS stored_value,
         valuable_data
  FROM o_nodes WHERE id % 14 <> 3
  UNION ALL
  SELECT id + (SELECT n FROM n_parts), (children+1) % 7, (props+3) % 20, CAST(1 AS BIGINT),
         (prop_value_range+40) % 100, max_depth, max_branching_factor, (max_properties+7) % 20,
         stored_value * {D(0.9)}, false
  FROM o_nodes WHERE id % 14 <> 3 AND id % 15 = 4),
p_edges AS (
  SELECT src, dst,
         CASE WHEN (src*31+dst) % 80 = 5 THEN CAST(CAST(weight AS BIGINT) % 9 + 1 AS DOUBLE) ELSE weight END AS weight
  FROM o_edges
  WHERE src % 14 <> 3 AND dst % 14 <> 3 AND (src*31+dst) % 25 <> 2
  UNION ALL
  SELECT id, id + (SELECT n FROM n_parts), CAST(id % 9 + 1 AS DOUBLE)
  FROM o_nodes WHERE id % 14 <> 3 AND id % 15 = 4
  UNION ALL
  SELECT id + (SELECT n FROM n_parts), (id*7+1) % (SELECT n FROM n_parts), CAST(id % 5 + 1 AS DOUBLE)
  FROM o_nodes WHERE id % 14 <> 3 AND id % 15 = 4 AND id % 30 = 4
    AND ((id*7+1) % (SELECT n FROM n_parts)) % 14 <> 3)
"""

MOVE_CTES = f"""
moves AS (
  SELECT user_id AS game_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
         ts,
         CASE WHEN event_type IN ('click', 'view') THEN '{C.THIEF}'
              WHEN event_type IN ('purchase', 'signup') THEN '{C.POLICEMAN}'
              WHEN event_id % 3 = 0 THEN 'restart'
              ELSE 'bystander' END AS "user",
         CAST(floor(value) AS BIGINT) % {C.BOARD_SIZE} AS target,
         event_id
  FROM events),
board_nodes AS (
  SELECT i AS id,
         (i*5+1) % 7 AS children,
         (i*11+3) % 20 AS props,
         CAST(CASE WHEN i % 50 = 0 THEN 2 ELSE 1 END AS BIGINT) AS current_depth,
         i*4+1 AS prop_value_range,
         (i*3) % 5 AS max_depth,
         (i*13+2) % 7 AS max_branching_factor,
         (i*17+5) % 20 AS max_properties,
         CAST((i*7919) % 100003 AS DOUBLE) / {D(100003)} AS stored_value,
         i = {C.BOARD_VALUABLE} AS valuable_data
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(0, {C.BOARD_SIZE}))),
board_edges AS (
  SELECT i AS src, (i+1) % {C.BOARD_SIZE} AS dst, {D(1.0)} AS weight
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(0, {C.BOARD_SIZE})) WHERE i % 12 <> 11
  UNION ALL
  SELECT i, (i+7) % {C.BOARD_SIZE}, {D(1.0)}
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(0, {C.BOARD_SIZE})) WHERE i % 12 <> 11),
board_p_edges AS (SELECT * FROM board_edges WHERE (src+dst) % 9 <> 4),
board_rewired AS (
  SELECT * FROM board_p_edges UNION ALL
  SELECT i, (i+3) % {C.BOARD_SIZE}, {D(1.0)}
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(0, {C.BOARD_SIZE})) WHERE i % 2 = 1)
"""


def with_ctes(body: str, *extra: str, graph: bool = True, moves: bool = False,
              recursive: bool = False) -> str:
    parts = []
    if graph:
        parts.append(GRAPH_CTES.strip())
    if moves:
        parts.append(MOVE_CTES.strip())
    parts.extend(e.strip() for e in extra if e.strip())
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()
