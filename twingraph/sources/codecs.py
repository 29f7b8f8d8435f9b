"""Row codecs as column jobs (S4-S6, P3, P11): node text, pair lines, JSON.

Nothing here parses row by row in Python: rendering is ``concat_ws`` /
``to_json``, parsing is ``regexp_extract`` + ``split`` + ``try_cast`` /
``from_json``; malformed input gives NULLs and an arity instead of an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..operators.kernel import HOT, cut_lineage, prefix_rank
from ..schemas import NODE, NODE_FIELDS, NODE_TEXT_PREFIX

NODE_OUT = list(NODE_FIELDS)


def _text_fields(prefix: str = "") -> list:
    return [F.col(f"{prefix}{c}").cast("string") for c in NODE_FIELDS]


def nodes_to_text(nodes: DataFrame) -> DataFrame:
    """Render nodes as ``NodeObject(f1,...,f10)`` lines (column ``value``)."""
    return nodes.select(F.concat(F.lit(NODE_TEXT_PREFIX), F.concat_ws(",", *_text_fields()), F.lit(")"))
                        .alias("value"))


def parse_nodes(lines: DataFrame, col: str = "value") -> DataFrame:
    """Parse the first parenthesised group of each line into NODE columns.

    Adds ``arity`` (number of fields) and ``valid`` (exactly 10 fields, all
    typed); invalid lines are kept so the caller can route them to a reject
    table instead of failing the job.
    """
    # The node record itself when present (also inside Move(...)), else the first group.
    inner = F.coalesce(F.nullif(F.regexp_extract(F.col(col), r"NodeObject\(([^()]*)\)", 1), F.lit("")),
                       F.regexp_extract(F.col(col), r"\((.*?)\)", 1))
    parts = F.split(inner, ",")
    out = lines.withColumn("_parts", parts)
    typed = []
    for i, f in enumerate(NODE.fields):
        raw = F.trim(F.try_element_at(F.col("_parts"), F.lit(i + 1)))
        typed.append(raw.try_cast(f.dataType).alias(f.name))
    res = out.select("*", *typed, F.size("_parts").alias("arity")).drop("_parts")
    ok = F.col("arity") == len(NODE_FIELDS)
    for f in NODE.fields:
        ok = ok & F.col(f.name).isNotNull()
    return res.withColumn("valid", ok)


def node_rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("valid"))


# FIXED values: keys of the JSON documents, in the order of NODE_FIELDS.
_JSON_KEYS = ["id", "children", "props", "currentDepth", "propValueRange", "maxDepth",
              "maxBranchingFactor", "maxProperties", "storedValue", "valuableData"]
# The flag is written as a string.
_NODE_JSON = T.StructType([T.StructField(k, T.StringType() if f.name == "valuable_data" else f.dataType)
                           for k, f in zip(_JSON_KEYS, NODE.fields)])
_MOVE_JSON = T.StructType([T.StructField("userId", T.StringType()), T.StructField("node", _NODE_JSON)])


def _json_node(prefix: str = "") -> F.Column:
    """The NODE columns ``<prefix><field>`` as one JSON-shaped struct."""
    return F.struct(*[F.col(f"{prefix}{c}").cast("string" if c == "valuable_data" else NODE[c].dataType).alias(k)
                      for c, k in zip(NODE_FIELDS, _JSON_KEYS)])


def _node_columns(doc: str) -> list[F.Column]:
    return [F.col(f"{doc}.{k}").try_cast(NODE[c].dataType).alias(c) for c, k in zip(NODE_FIELDS, _JSON_KEYS)]


def nodes_to_json(nodes: DataFrame) -> DataFrame:
    """One JSON document per node; the flag is written as a string."""
    return nodes.select(F.to_json(_json_node()).alias("json"))


def _read_nodes(docs: DataFrame, col: str) -> DataFrame:
    parsed = docs.select(F.col(col).alias("_doc"), F.from_json(F.col(col), _NODE_JSON).alias("n"))
    return parsed.select("_doc", *_node_columns("n"))


def _complete() -> F.Column:
    ok = F.lit(True)
    for c in NODE_FIELDS:
        ok = ok & F.col(c).isNotNull()
    return ok


def nodes_from_json(docs: DataFrame, col: str = "json") -> DataFrame:
    """Read node documents back; those with a missing or mistyped field are left to :func:`json_rejects`."""
    return _read_nodes(docs, col).where(_complete()).drop("_doc")


def json_rejects(docs: DataFrame, col: str = "json") -> DataFrame:
    """The documents that lack a field or hold one of another type, as they are (column ``col``)."""
    return _read_nodes(docs, col).where(~_complete()).select(F.col("_doc").alias(col))


def moves_to_json(moves: DataFrame, nodes: DataFrame) -> DataFrame:
    """One Move document per move whose target is a node: ``(game_id, seq, json)``; see :func:`move_rejects`."""
    at = nodes.select(*[F.col(c).alias(f"_n_{c}") for c in NODE_FIELDS])
    j = moves.join(at, moves["target"] == at["_n_id"])
    doc = F.struct(F.col("user").alias("userId"), _json_node("_n_").alias("node"))
    return j.select("game_id", "seq", F.to_json(doc).alias("json"))


def move_rejects(moves: DataFrame, nodes: DataFrame) -> DataFrame:
    """The moves that have no document, as their target is null or no node."""
    return moves.join(nodes.select(F.col("id").alias("_id")), moves["target"] == F.col("_id"), "left_anti")


def _read_moves(docs: DataFrame, col: str) -> DataFrame:
    rest = [c for c in docs.columns if c != col]
    parsed = docs.select("*", F.from_json(F.col(col), _MOVE_JSON).alias("m"))
    return parsed.select(*rest, F.col(col).alias("_doc"), F.col("m.userId").alias("user"), *_node_columns("m.node"))


def moves_from_json(docs: DataFrame, col: str = "json") -> DataFrame:
    """Move documents as their other columns, ``user`` and the NODE columns of the target.

    Those without a user, or whose node lacks a field or holds one of another type, are left to :func:`move_json_rejects`.
    """
    return _read_moves(docs, col).where(_complete() & F.col("user").isNotNull()).drop("_doc")


def move_json_rejects(docs: DataFrame, col: str = "json") -> DataFrame:
    """The documents that :func:`moves_from_json` leaves, as they are."""
    bad = _read_moves(docs, col).where(~_complete() | F.col("user").isNull())
    return bad.select(*[c for c in docs.columns if c != col], F.col("_doc").alias(col))


# FIXED values: keys of the document of a player's moves and status.
_STATUS_JSON = T.StructType([
    T.StructField("moves", T.ArrayType(_MOVE_JSON)), T.StructField("adjacentNodes", T.ArrayType(_NODE_JSON)),
    T.StructField("distanceToValuableNode", T.DoubleType()), T.StructField("pathToValuableNode", T.ArrayType(_NODE_JSON)),
    T.StructField("confidenceScore", T.DoubleType())])


def status_documents(status: DataFrame, moves: DataFrame, nodes: DataFrame, per_document: int = 1000) -> DataFrame:
    """``(game_id, role, part, json)``, the moves and the status of every player as documents.

    ``status`` is that of :func:`status.player_status`. A document holds at most ``per_document`` moves, in
    ``seq`` order; a player with more has several parts, each with the status. An unreachable target has
    the distance ``2147483647`` and an empty path. Moves to no node are left out (:func:`move_rejects`).
    """
    key = ["game_id", "role"]
    status = cut_lineage(status)  # read by every part of a document
    at = nodes.select(F.col("id").alias("_id"), _json_node().alias("node"))

    def listed(ids: str, out: str) -> DataFrame:
        one = status.select(*key, F.posexplode(F.col(ids).cast("array<bigint>")).alias("i", "_id")).where("_id is not null")
        rows = one.join(at, "_id").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("i", "node"))).alias("l"))
        return rows.select(*key, F.transform("l", lambda x: x["node"]).alias(out))

    own = (moves.select("game_id", F.lower("user").alias("role"), "seq", F.col("user").alias("userId"), F.col("target").alias("_id"))
           .join(status.select(*key), key, "left_semi").join(at, "_id"))
    own = prefix_rank(own.select(*key, "seq", "userId", "node"), key, ["seq"], out="_n", hot=HOT)
    parts = (own.groupBy(*key, F.expr(f"_n div {per_document}").alias("part"))
             .agg(F.sort_array(F.collect_list(F.struct("seq", "userId", "node"))).alias("l"))
             .select(*key, "part", F.transform("l", lambda x: F.struct(x["userId"].alias("userId"), x["node"].alias("node"))).alias("moves")))
    whole = (status.select(*key, "distance", "confidence").join(listed("adjacent_ids", "adjacentNodes"), key, "left")
             .join(listed("path_ids", "pathToValuableNode"), key, "left").join(parts, key, "left"))
    empty = lambda c, i: F.coalesce(c, F.array().cast(_STATUS_JSON[i].dataType))
    doc = F.struct(empty("moves", 0).alias("moves"), empty("adjacentNodes", 1).alias("adjacentNodes"),
                   F.coalesce("distance", F.lit(float(C.UNREACHABLE))).alias("distanceToValuableNode"),
                   empty("pathToValuableNode", 3).alias("pathToValuableNode"), F.col("confidence").alias("confidenceScore"))
    return whole.select(*key, F.coalesce("part", F.lit(0)).cast("bigint").alias("part"), F.to_json(doc).alias("json"))


def status_from_json(docs: DataFrame, col: str = "json") -> DataFrame:
    """Status documents as their other columns and one column for each of their five keys."""
    rest = [c for c in docs.columns if c != col]
    return docs.select(*rest, F.from_json(F.col(col), _STATUS_JSON).alias("d")).select(*rest, "d.*")


def pair_lines(pairs: DataFrame) -> DataFrame:
    """Pair text ``"<original fields>, <perturbed fields>"``; a missing side is empty fields."""
    o = [F.coalesce(c, F.lit("")) for c in _text_fields("o_")]
    p = [F.coalesce(c, F.lit("")) for c in _text_fields("p_")]
    line = F.concat_ws(", ", F.concat_ws(",", *o), F.concat_ws(",", *p))
    return pairs.select(F.coalesce("o_id", "p_id").alias("line_id"), line.alias("line"))


def extract_node_number(line) -> F.Column:
    """Field 11 (the perturbed id) as BIGINT; NULL if absent or not an integer."""
    line = F.col(line) if isinstance(line, str) else line
    return F.trim(F.try_element_at(F.split(line, ","), F.lit(11))).try_cast("bigint")


def read_pairs(spark, path: str, header: bool = False) -> DataFrame:
    """Pair lines from CSV text, addressed by name (o_* and p_* fields).

    P7: with ``header`` the first line of every file is a header; by default every line is data.
    """
    fields = [T.StructField(f"{s}{f.name}", f.dataType) for s in ("o_", "p_") for f in NODE.fields]
    return spark.read.csv(path, schema=T.StructType(fields), header=header, enforceSchema=True,
                          ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def read_nodes_csv(spark, path: str, header: bool = False) -> DataFrame:
    """Node lines as the node CSV writer leaves them; ``header`` as in :func:`read_pairs`."""
    return spark.read.csv(path, schema=NODE, header=header, enforceSchema=True, ignoreLeadingWhiteSpace=True,
                          ignoreTrailingWhiteSpace=True)
