"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

NODE_FIELDS = [
    "id", "children", "props", "current_depth", "prop_value_range", "max_depth",
    "max_branching_factor", "max_properties", "stored_value", "valuable_data",
]
NODE_PROPS = NODE_FIELDS[1:]

NODE = T.StructType(
    [T.StructField(n, T.LongType()) for n in NODE_FIELDS[:8]]
    + [T.StructField("stored_value", T.DoubleType()), T.StructField("valuable_data", T.BooleanType())]
)

EDGE = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("weight", T.DoubleType()),
])

DELTA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("change", T.StringType()),
    T.StructField("a", T.LongType()),
    T.StructField("b", T.LongType()),
])

MOVE = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user", T.StringType()),
    T.StructField("target", T.LongType()),
])

# A node rendered to text by the reference: NodeObject(f1,...,f10).
NODE_TEXT_PREFIX = "NodeObject("
