"""Spark session helpers.

The engine never owns the cluster configuration: it reads what the session
already carries and only fills gaps when running locally (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cpus: int | str = "*", app: str = "twingraph", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster the folder must be configured (``spark.checkpoint.dir`` or
    ``SparkContext.setCheckpointDir``) and point at shared storage; we never
    invent a machine-local one there. Only a local session without a setting
    gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder for lineage cuts")
    base = os.environ.get("TWINGRAPH_SCRATCH") or tempfile.gettempdir()
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="twingraph-ckpt-", dir=base))
    return sc.getCheckpointDir()


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables; the innermost scope removes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables written inside when it ends; use results before that."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            drop_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table, wherever the shared folder lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies at the driver's path.

    On a cluster that has it elsewhere, ship it with ``--py-files`` as usual.
    """
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *known])
