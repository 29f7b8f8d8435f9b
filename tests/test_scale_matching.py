"""The best matches never join rows by rows: candidate pairs are asked of cells alone."""

from twingraph import fixtures as fx
from twingraph.operators import similarity as sim

from .conftest import SF_SMALL


def test_candidates_are_asked_of_cells(spark, monkeypatch):
    g = fx.graph_pair(spark, SF_SMALL)
    plain, seen = sim.candidate_pairs, []
    monkeypatch.setattr(sim, "candidate_pairs", lambda o, p, t, props=None: seen.append(props) or plain(o, p, t, props))
    assert sim.best_match_exact(g.o_nodes, g.p_nodes).count() > 0
    assert sim.best_match_top(g.o_nodes, g.p_nodes, 2).count() > 0
    assert seen and all(props and "stored_value" not in props for props in seen)


def test_counting_keeps_originals_in_their_class(spark, monkeypatch):
    """More originals add rows for themselves, not for every class that asks for them."""
    plain, seen = sim.prefix_sum, []
    monkeypatch.setattr(sim, "prefix_sum", lambda df, *a, **kw: seen.append(df.count()) or plain(df, *a, **kw))
    schema = fx.graph_pair(spark, SF_SMALL).o_nodes.schema

    def nodes(n, *limits, children=1):
        return spark.createDataFrame([(i, i % children, 4, 1, 9, *limits, 0.5 + i / 1e5, False) for i in range(n)], schema)

    def rows(n):
        seen.clear()
        # equal in 22 points of 41: both ranged properties are needed
        counted = sim.match_counts(sim.profiles(nodes(n, 2, 5, 6)), sim.profiles(nodes(40, 20, 50, 60, children=40))).collect()
        assert {r["n_matches"] for r in counted} == {n}
        return sum(seen)

    assert rows(400) - rows(200) <= 4 * 200
