"""The fold of the moves is not repeated for every use of its results."""

from twingraph.operators import replay as R


def test_positions_come_from_a_written_fold(spark):
    rows = spark.createDataFrame([(1, 0, 4, 5), (1, 1, 6, 7)], "game_id long, round long, thief_node long, police_node long")
    folded = rows.mapInArrow(lambda batches: batches, rows.schema)
    latest = R.latest_positions(folded)
    assert "MapInArrow" not in latest._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, latest.collect())) == [(1, "policeman", 7), (1, "thief", 6)]
