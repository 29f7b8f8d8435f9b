"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints ONE JSON line. Each query is fully
executed with the ``noop`` sink (no driver collect). The graph pair is derived
once before them (``fixture``), so a query's time is that of its operator; the
total has both. A query's intermediate tables are removed when it ends.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_node_diff",            # T1: full outer join on id
    "q_confidence",           # C1: degree / shared-edge aggregates
    "q_edge_traceability",    # X6 + A1/A2
    "q_best_match",           # X10: exact candidate join
    "q_random_walks",         # W1: iterative frontier join
    "q_nearest_valuable",     # D1: multi-source BFS
    "q_replay_moves",         # M4: per-game fold
    "q_pair_report",          # A12: two-level prefix sums
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("TWINGRAPH_SCRATCH", tempfile.mkdtemp(prefix="bench-"))
    from twingraph.plans.queries import queries
    from twingraph.fixtures import graph_pair
    from twingraph.session import local_session, scratch_scope

    spark = local_session(cpus, app="twingraph-bench",
                          extra={"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    qs = queries()
    only = [q for q in sys.argv[1:] if q in qs] or HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up
    times = {}
    t0 = time.time()
    graph_pair(spark, sf_dir).p_edges.count()
    fixture = round(time.time() - t0, 3)
    for name in only:
        t0 = time.time()
        with scratch_scope(spark):
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(fixture + sum(times.values()), 3), "unit": "sec",
                      "queries": times, "fixture": fixture, "sf": sf}))


if __name__ == "__main__":
    main()
