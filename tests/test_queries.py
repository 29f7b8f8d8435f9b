"""Every registered query against its DuckDB oracle on sf0.001 (the driver's gate, smaller)."""

import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from twingraph.fixtures import graph_pair
from twingraph.plans.oracles import oracle_sql
from twingraph.plans.queries import queries
from twingraph.session import scratch_scope

from .conftest import SF_SMALL

TABLES = ["part", "lineitem", "events", "orders", "customer", "supplier", "nation", "region"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(E.queries())


@pytest.fixture(scope="module")
def pair(spark):
    g = graph_pair(spark, SF_SMALL)
    g.p_edges.count()  # written outside the queries' scopes
    return g


#: Queries whose rows pass through a Python worker: the folds of the move log.
FOLDED = ("q_replay_moves", "q_game_outcomes", "q_replay_illegal_loses", "q_outcomes_illegal_loses", "q_latest_positions", "q_player_status",
          "q_opponent_view", "q_report_lines", "q_status_of_users", "q_status_documents")


def check_plan(name, df):
    """No cross product, no row-wise Python, and no task that takes all rows: only partial aggregates go to one."""
    plan = [x.strip(" :+-*()0123456789") for x in df._jdf.queryExecution().executedPlan().toString().split("\n")]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert not any(x.startswith(bad) for x in plan), f"{name}: {bad}"
    if name not in FOLDED:
        assert not any("InArrow" in x for x in plan), name
    for above, below in zip(plan, plan[1:]):
        if above.startswith("Exchange SinglePartition"):
            assert "Aggregate(keys=[]" in below or "Aggregate(keys=[_slice" in below, f"{name}: {below}"


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, pair, name):
    with scratch_scope(spark):
        df = queries()[name](spark, SF_SMALL)
        check_plan(name, df)
        rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "n_edges", "shared", "same_degree", "present", "score"]
