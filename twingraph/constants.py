"""Fixed values shared by the Spark queries and their SQL oracles.

Values marked FIXED must equal the behaviour being reproduced; the rest are
parameters of the derived fixtures and of the registered queries.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED values: tolerant node score (property, base tolerance %, reward points).
# Tolerance used is base * (1 + 0.2); a reward of 10 points = 0.10.
# ---------------------------------------------------------------------------
TOLERANCE_MODIFIER = 0.2
TOLERANT_PROPS = [
    ("prop_value_range", 5.75, 10),
    ("max_branching_factor", 14.50, 10),
    ("stored_value", 13.5, 15),
    ("max_depth", 13.75, 4),
    ("children", 7.50, 4),
    ("current_depth", 10.0, 2),
    ("props", 8.85, 20),
    ("max_properties", 16.75, 10),
]
VALUABLE_POINTS = 15
TOTAL_POINTS = 90  # sum of all rewards (0.90)
SIMILARITY_THRESHOLD = 0.9  # score = (points / 90) / 0.9 = points / 81
SCORE_DIVISOR = 81

# FIXED values: strict node score (exact equality), points per property.
STRICT_PROPS = [
    ("prop_value_range", 15),
    ("max_branching_factor", 10),
    ("max_depth", 8),
    ("children", 8),
    ("current_depth", 2),
    ("props", 20),
    ("max_properties", 10),
]
STRICT_STORED_VALUE_POINTS = 17
STRICT_STORED_VALUE_RATIO = 1.56

# FIXED values: edge score.
EDGE_WEIGHT_TOLERANCE = 5.75  # percent, no modifier
EDGE_MATCH_SCORE = 1.11  # (0.9 / 0.9) / 0.9 rounded to two decimals

# FIXED values: edge traceability thresholds.
EDGE_ACCEPT = 0.41
EDGE_KEEP = 0.3
EDGE_CTL = 0.31
EDGE_WTL = 0.15
EDGE_DTL = 0.36

# FIXED values: node traceability thresholds.
NODE_ACCEPT = 0.5
NODE_KEEP = 0.3
NODE_EVEN = 0.71
NODE_CTL = 0.75
NODE_WTL = 0.47
NODE_DTL = 0.9
NODE_ABOVE_OVERRIDE = 0.9
VERDICT_PRECISION = 88.0

# FIXED values: attack tally.
ATTACK_DRAW = 0.75
ATTACK_SCORE = 0.55

# FIXED values: graph-level counters on the strict score.
GRAPH_ACCEPT = 0.5
GRAPH_WRONG = 0.03
GRAPH_DISCARD_CTL = 0.3
GRAPH_DISCARD_NONE = 0.06

# FIXED values: sentinels and formats.
UNREACHABLE = 2147483647  # Int.MaxValue
INFINITY_TEXT = "-"
EXTRACT_GROUP = 10
SHARD_SIZE = 35

# FIXED values: player roles.
THIEF = "thief"
POLICEMAN = "policeman"

# ---------------------------------------------------------------------------
# Engine-independent pseudo randomness (integer only, BIGINT safe).
# ---------------------------------------------------------------------------
HASH_A = 48271
HASH_B = 69621
HASH_C = 7919
HASH_MOD = 2147483647
HASH_MIX = 46337
HASH_SHIFT = 65536

# ---------------------------------------------------------------------------
# Parameters of the registered queries.
# ---------------------------------------------------------------------------
SEED = 42
N_WALKS = 500
MAX_STEPS = 50
BEST_MATCH_MIN_POINTS = 41  # score >= 0.5
WINDOW_MINUTES = 60

# Board for the move log (small on purpose: games are the scale axis).
BOARD_SIZE = 25
BOARD_VALUABLE = 13
