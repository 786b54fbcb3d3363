"""Plugin ordering (O1 + U1 over file listings).

Pre- and post-deployment plugins are ``pre-<n>*.sh`` / ``post-<n>*.sh``
files in a global and a local plugin folder. They are listed (S1), kept by
name, and ordered global first, then local, each by the number after the
first dash of the file name (non-numeric counts as 0, the whole name breaks
ties). When both folders are the same place the global list is skipped, so
nothing appears twice. Only the order is produced; running the plugins is
outside Spark's job.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.functions.paths import base_name
from shiplog.operators.ordering import union_with_precedence
from shiplog.sources.tree import tree_inventory

PHASES = ("pre", "post")


def _plugins(spark: SparkSession, folder: str | None, phase: str) -> DataFrame:
    empty = spark.createDataFrame([], "path string")
    if not folder or not os.path.isdir(folder):
        return empty
    listed = tree_inventory(spark, folder).withColumn(
        "path", F.concat(F.lit(os.path.abspath(folder).rstrip("/") + "/"), F.col("path"))
    )
    return listed.where(base_name("path").rlike(rf"^{phase}-.*\.sh\z"))


def plugin_order(spark: SparkSession, global_dir: str | None, local_dir: str | None, phase: str = "pre") -> DataFrame:
    """``DF(layer, path, ord)``: the plugins of one phase in run order."""
    if phase not in PHASES:
        raise ValueError(f"phase must be one of {PHASES}")
    same = bool(global_dir and local_dir) and os.path.abspath(global_dir) == os.path.abspath(local_dir)
    return union_with_precedence(
        _plugins(spark, global_dir, phase), _plugins(spark, local_dir, phase), "path", same_location=same
    ).select("layer", "path", "ord")
