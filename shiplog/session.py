"""Session construction and shared-storage helpers.

Library functions never configure the session they are given; these helpers
are for tests, the benchmark and local runs.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(
    app: str = "shiplog",
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
) -> SparkSession:
    """Local session with AQE, skew-join handling and the UI switched off."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder is not
    visible to other executors). In local mode, when it is unset, a fresh
    folder under the system temp area is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="shiplog-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    spark.conf.set("spark.checkpoint.dir", local)
    return local


_SCOPES: list[list[str]] = []


def mounted_path(path: str) -> str | None:
    """The path on the mounted file system, None for a URI of another store."""
    parts = urlparse(path)
    if not parts.scheme:
        return path
    return unquote(parts.path) if parts.scheme == "file" else None


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique location below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = "/".join([root, "shiplog", *parts, uuid.uuid4().hex])
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the scratch folders created inside the block when it ends.

    DataFrames built inside the block may read those folders lazily, so
    write or collect their results before leaving it.
    """
    created: list[str] = []
    _SCOPES.append(created)
    try:
        yield created
    finally:
        _SCOPES.pop()
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in created:
            p = jvm.org.apache.hadoop.fs.Path(path)
            fs = p.getFileSystem(conf)
            if fs.exists(p):
                fs.delete(p, True)


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Write ``df`` as a parquet table below the shared checkpoint folder and
    read it back.

    Used where one result feeds two branches of a plan: both read the same
    stored rows (no recomputation, no chance of differing re-evaluation) and
    the lineage is cut, so a lost executor does not replay upstream work.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
