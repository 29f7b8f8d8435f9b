"""Readers and writers on small fixtures in the reference's formats."""

import os

from pyspark.sql import functions as F

from twingraph.operators import diff
from twingraph.sources import codecs, readers, sinks

DOT = '''digraph "five towns" {
edge ["style"="thin"]
"0" ["shape"="box","label"="harbour"]
"4"
"0" -> "1" ["weight"="4.0"]
"1" -> "2" ["style"="bold","weight"="1.0"]
"2" -> "0" ["weight"="6.5"];
"2" -> "3" ["shape"="dotted"]
"3" -> "3"
"north" -> "3" ["weight"="2.0"]
}
'''

REPORT = """Nodes:
\tModified: [7, 3, 11]
\tRemoved: [5, 9]
\tAdded:
\t\t2: 20
\t\t3: 21
Edges:
\tModified:
\t\t1: 2
\tAdded:
\t\t5: 44
\t\t2: 20
\tRemoved:
\t\t5: 44
\t\t5: 9
\t\t9: 1
"""


def _write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_dot(spark, tmp_dir):
    p = _write(tmp_dir, "g.dot", DOT)
    edges, nodes = readers.read_dot(spark, p)
    assert edges.count() == 5
    assert [r["line"] for r in readers.dot_rejects(spark, p).collect()] == ['"north" -> "3" ["weight"="2.0"]']
    assert sorted(r["id"] for r in nodes.collect()) == [0, 1, 2, 3, 4]  # isolated "4" kept
    w = {(r["src"], r["dst"]): r["weight"] for r in edges.collect()}
    assert w[(2, 0)] == 6.5 and w[(1, 2)] == 1.0
    assert w[(2, 3)] is None and w[(3, 3)] is None  # an edge without a weight is an edge


def test_read_delta_counts_and_repeated_keys(spark, tmp_dir):
    p = _write(tmp_dir, "g.yaml", REPORT)
    d = readers.read_delta(spark, p)
    counts = {(r["entity"], r["change"]): r["count"] for r in d.groupBy("entity", "change").count().collect()}
    assert counts == {("Nodes", "Modified"): 3, ("Nodes", "Removed"): 2, ("Nodes", "Added"): 2,
                      ("Edges", "Modified"): 1, ("Edges", "Added"): 2, ("Edges", "Removed"): 3}
    assert d.where("entity = 'Edges' AND change = 'Removed' AND a = 5").count() == 2


def test_reconcile_operation_log(spark, tmp_dir):
    """T4: the report is an operation log; an edge added then removed is not in a set diff."""
    report = readers.read_delta(spark, _write(tmp_dir, "r.yaml", REPORT))
    set_diff = report.where(~((F.col("entity") == "Edges") & (F.col("a") == 5) & (F.col("b") == 44)))
    r = diff.reconcile(set_diff, report)
    only_report = {(x["change"], x["a"], x["b"]) for x in r.where("in_report AND NOT in_diff").collect()}
    assert only_report == {("Added", 5, 44), ("Removed", 5, 44)}
    assert r.where("in_diff AND NOT in_report").count() == 0


def test_report_writer_round_trip(spark, tmp_dir):
    report = readers.read_delta(spark, _write(tmp_dir, "r.yaml", REPORT)).select("entity", "change", "a", "b")
    out = os.path.join(tmp_dir, "out")
    sinks.delta_report_docs(report.distinct(), chunk=2).write.text(out)
    back = readers.read_delta(spark, out).select("entity", "change", "a", "b")
    assert back.exceptAll(report.distinct()).count() == 0
    assert report.distinct().exceptAll(back).count() == 0


def test_parse_nodes_and_rejects(spark):
    lines = spark.createDataFrame([
        ("NodeObject(12,1,4,2,30,3,5,7,0.125,true)",),
        ("Move(thief,NodeObject(34,0,8,1,22,2,4,9,0.375,false))",),
        ("NodeObject(1,2,3,4,5,6,7,8,9)",),
        ("garbage",)], ["value"])
    p = codecs.parse_nodes(lines).collect()
    assert p[0]["id"] == 12 and p[0]["stored_value"] == 0.125 and p[0]["valuable_data"] is True
    assert p[1]["id"] == 34 and p[1]["valid"]
    assert p[2]["arity"] == 9 and not p[2]["valid"]
    assert not p[3]["valid"]


def test_json_codec_writes_flag_as_string(spark):
    lines = spark.createDataFrame([("NodeObject(1,2,3,4,5,6,7,8,0.25,true)",)], ["value"])
    nodes = codecs.parse_nodes(lines).select(*codecs.NODE_OUT)
    doc = codecs.nodes_to_json(nodes).first()["json"]
    assert '"valuableData":"true"' in doc and '"maxBranchingFactor":7' in doc
    back = codecs.nodes_from_json(codecs.nodes_to_json(nodes))
    assert back.exceptAll(nodes).count() == 0


def test_json_rejects_other_keys_and_types(spark):
    good = ('{"id":1,"children":2,"props":3,"currentDepth":1,"propValueRange":9,"maxDepth":2,"maxBranchingFactor":4,'
            '"maxProperties":5,"storedValue":0.5,"valuableData":"false"}')
    bad = [good.replace("maxDepth", "max_depth"), good.replace('"id":1', '"id":"one"'), "no json"]
    docs = spark.createDataFrame([(d,) for d in [good, *bad]], "json string")
    assert [r["id"] for r in codecs.nodes_from_json(docs).collect()] == [1]
    assert sorted(r["json"] for r in codecs.json_rejects(docs).collect()) == sorted(bad)


def test_extract_node_number(spark):
    df = spark.createDataFrame([("1,2,3,4,5,6,7,8,9,true, 42,2,3,4,5,6,7,8,9,false",), ("1,2",),
                                ("1,2,3,4,5,6,7,8,9,true, x,2",)], ["line"])
    got = [r["n"] for r in df.select(codecs.extract_node_number("line").alias("n")).collect()]
    assert got == [42, None, None]


def test_csv_sinks_round_trip(spark, tmp_dir):
    lines = spark.createDataFrame([(f"NodeObject({i},2,3,1,5,6,7,8,0.{i}5,false)",) for i in range(1, 30)], ["value"])
    nodes = codecs.parse_nodes(lines).select(*codecs.NODE_OUT)
    sinks.write_nodes_csv(nodes, os.path.join(tmp_dir, "k1"))
    back = spark.read.csv(os.path.join(tmp_dir, "k1"))
    assert back.count() == 29 and len(back.columns) == 10
    assert codecs.read_nodes_csv(spark, os.path.join(tmp_dir, "k1")).exceptAll(nodes).count() == 0


def test_shards_are_packed_and_read_back(spark, tmp_dir):
    """Files hold many shards, a reader of many splits gets every row under its shard."""
    rows = spark.createDataFrame([(i, f'"q", #shard=3,{i}' if i % 7 else None, i / 8) for i in range(995)], "id long, text string, x double")
    sharded = sinks.shard(rows, ["id"], 10)
    path = os.path.join(tmp_dir, "k4")
    sinks.write_shards(sharded, path, per_file=40)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert 3 <= len(files) < 30
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        back = readers.read_shards(spark, path, "id long, text string, x double")
        assert back.exceptAll(sharded.select(*back.columns)).count() == 0 and back.count() == 995
        some = readers.read_shards(spark, path, "id long, text string, x double", shards=[3, 99])
        assert sorted(r["id"] for r in some.collect()) == [*range(30, 40), *range(990, 995)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_report_of_many_splits(spark, tmp_dir):
    """One report file in many splits: several tasks, the same rows, headers carried over the splits."""
    body = ["Nodes:", "\tModified: [1, 2, 3]", "\tRemoved: []", "\tAdded:", *[f"\t\t{i}: {i + 1}" for i in range(200)],
            "Edges:", "\tModified:", "\t\t1: 2", "\tRemoved:", *[f"\t\t{i}: {i % 3}" for i in range(400)], "\tAdded:", *[f"\t\t{i}: 9" for i in range(300)]]
    path = _write(tmp_dir, "big.yaml", "\n".join(body))
    whole = sorted(map(tuple, readers.read_delta(spark, path).select("entity", "change", "a", "b").collect()), key=str)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        split = sorted(map(tuple, readers.read_delta(spark, path).select("entity", "change", "a", "b").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    want = ([("Nodes", "Modified", i, None) for i in (1, 2, 3)] + [("Nodes", "Added", i, i + 1) for i in range(200)]
            + [("Edges", "Modified", 1, 2)] + [("Edges", "Removed", i, i % 3) for i in range(400)] + [("Edges", "Added", i, 9) for i in range(300)])
    assert whole == split == sorted(want, key=str)


def test_header_option_and_default(spark, tmp_dir):
    """By default the first line is data; with the option it is skipped in every file."""
    line = "1,2,3,1,5,6,7,8,0.5,true, 1,2,3,1,5,6,7,8,0.25,false"
    head = ",".join(["o_" + c for c in codecs.NODE_OUT] + ["p_" + c for c in codecs.NODE_OUT])
    os.makedirs(os.path.join(tmp_dir, "p"))
    for name in ("a", "b"):
        _write(os.path.join(tmp_dir, "p"), name + ".csv", f"{head}\n{line}\n{line}\n")
    assert codecs.read_pairs(spark, os.path.join(tmp_dir, "p"), header=True).count() == 4
    plain = codecs.read_pairs(spark, os.path.join(tmp_dir, "p"))
    assert plain.count() == 6 and plain.where("o_id = 1").count() == 4


def test_move_documents_and_rejects(spark):
    lines = spark.createDataFrame([(f"NodeObject({i},2,3,1,5,6,7,8,0.5,false)",) for i in range(3)], ["value"])
    nodes = codecs.parse_nodes(lines).select(*codecs.NODE_OUT)
    moves = spark.createDataFrame([(1, 1, "thief", 0), (1, 2, "policeman", 9), (1, 3, "thief", None), (1, 4, None, 1)],
                                  "game_id long, seq long, user string, target long")
    docs = codecs.moves_to_json(moves, nodes)
    assert sorted(r["seq"] for r in docs.collect()) == [1, 4]
    assert sorted(r["seq"] for r in codecs.move_rejects(moves, nodes).collect()) == [2, 3]
    more = docs.unionByName(spark.createDataFrame([(1, 7, "no json"), (1, 8, '{"userId":"thief","node":{"id":1}}')], docs.schema))
    assert [r["seq"] for r in codecs.moves_from_json(more).collect()] == [1]
    assert sorted(r["seq"] for r in codecs.move_json_rejects(more).collect()) == [4, 7, 8]


def test_parquet_graph_round_trip(spark, tmp_dir):
    from twingraph import fixtures as fx
    from .conftest import SF_SMALL
    g = fx.graph_pair(spark, SF_SMALL)
    readers.write_graph(g.p_nodes, g.p_edges, os.path.join(tmp_dir, "g"))
    nodes, edges = readers.read_graph(spark, os.path.join(tmp_dir, "g"))
    assert nodes.exceptAll(g.p_nodes).count() == 0 and nodes.count() == g.p_nodes.count()
    assert edges.exceptAll(g.p_edges.select("src", "dst", "weight")).count() == 0


def test_read_pairs_by_name(spark, tmp_dir):
    p = _write(tmp_dir, "pairs.csv",
               "1,2,3,1,5,6,7,8,0.5,true, 1,2,3,1,5,6,7,8,0.25,false\n"
               "2,2,3,1,5,6,7,8,0.5,false, 9,2,3,1,5,6,7,8,0.75,true\n")
    df = codecs.read_pairs(spark, p)
    rows = {r["o_id"]: r for r in df.collect()}
    assert rows[1]["p_stored_value"] == 0.25 and rows[2]["p_id"] == 9 and rows[2]["p_valuable_data"] is True


def test_pair_and_status_writers(spark, tmp_dir):
    from twingraph import fixtures as fx
    from twingraph.operators import similarity as sim
    from .conftest import SF_SMALL
    g = fx.graph_pair(spark, SF_SMALL)
    pairs = sim.pairs_by_id(g.o_nodes, g.p_nodes, "full_outer")
    sinks.write_node_pairs_csv(pairs, os.path.join(tmp_dir, "k2"))
    k2 = spark.read.option("header", True).csv(os.path.join(tmp_dir, "k2"))
    assert k2.columns == sinks.PAIR18 and k2.count() == pairs.count()
    ep = sim.edge_pairs(g.o_edges, g.p_edges)
    sinks.write_edge_pairs_csv(ep, os.path.join(tmp_dir, "k3"))
    k3 = spark.read.option("header", True).csv(os.path.join(tmp_dir, "k3"))
    assert k3.columns == sinks.EDGE_PAIR6 and k3.count() == ep.count()
    assert k3.where("o_src IS NULL AND p_src IS NULL").count() == 0
    status = spark.createDataFrame([(1, "thief", 3, "2,4", 2, 1.5, "3,4,13", 0.5, 7)],
                                   "game_id long, role string, node long, adjacent string, hops long, "
                                   "distance double, path string, confidence double, n_moves long")
    sinks.write_status_json(status, os.path.join(tmp_dir, "k10"))
    doc = spark.read.json(os.path.join(tmp_dir, "k10")).first()
    assert doc["status"]["path"] == "3,4,13" and doc["status"]["n_moves"] == 7
