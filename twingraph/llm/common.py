"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ASCII_SPACE = "\\x09-\\x0D\\x20"


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies at the driver's path.

    On a cluster that has it elsewhere, ship it with ``--py-files`` as usual.
    """
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table from the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage on storage that every executor sees, so a lost executor
    costs a re-read and not a re-run. Returns the table and its path.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def fold_of(doc_id, mod: int):
    """crc32 of the id's decimal text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % mod


def spans_gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of many spans, concatenated."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows (null: empty)."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = arr.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, 8 * arr.offset)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(n_bytes: np.ndarray, limit: int):
    """Row ranges whose bytes add up to about ``limit`` (one long row may exceed it)."""
    at = 0
    ends = np.cumsum(n_bytes)
    while at < len(n_bytes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to
        at = to


def small_batches(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Cut an Arrow batch into pieces with about ``limit`` bytes of ``column``."""
    sizes = batch.column(column)
    lens = np.asarray(pc.binary_length(sizes).fill_null(0), dtype=np.int64) if batch.num_rows else []
    for a, b in slices(np.asarray(lens, np.int64) + 16, limit):
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def with_text(df: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, str]:
    """``keep`` columns and the text column, which is not doubled where it is kept as a string anyway."""
    if text in keep and df.schema[text].dataType.simpleString() == "string":
        return df.select(*keep), text
    return df.select(*keep, df[text].cast("string").alias("_text")), "_text"


def positive_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
