"""Recursive inventory of a script source tree.

Regular files only (no symbolic links, no folders), any size including zero,
names starting with ``_`` or ``.`` below the top level included; paths are
relative to the root, ``/``-separated. (Spark's ``binaryFile`` source skips
``_``/``.`` names and empty files, so it cannot be used.)

The tree is listed level by level: the folders of a level are dealt over the
tasks, each task lists the folders it got (not what is below them), and the
folders found make the next level, until there are none. So a folder that
holds most of the tree is spread over the tasks as soon as its subfolders are
known, and the driver lists nothing. Top-level folders starting with a dot are
never listed. A tree on storage that every executor mounts at the same path is
listed there; a URI of another store (``hdfs://``, ``s3://``, ...) through that
store's own listing. One folder is listed by one task, in bounded batches, as
its names come one after the other from either.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.session import freeze, mounted_path


def _lister(root: str, batch_rows: int):
    mounted = mounted_path(root)

    def entries(rel: str) -> Iterator[tuple[str, bool, bool]]:
        """(name, folder, regular file) of what a folder holds."""
        if mounted is not None:
            with os.scandir(os.path.join(mounted, rel) if rel else mounted) as found:
                for e in found:
                    yield e.name, e.is_dir(follow_symlinks=False), e.is_file(follow_symlinks=False)
            return
        from pyarrow import fs as pafs

        store, top = pafs.FileSystem.from_uri(root)
        for e in store.get_file_info(pafs.FileSelector(f"{top}/{rel}" if rel else top)):
            yield e.base_name, e.type == pafs.FileType.Directory, e.type == pafs.FileType.File

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # paths are streamed in bounded batches: a flat folder with millions
        # of files never sits in one task's memory at once
        rows: list[tuple[str, bool]] = []
        for b in batches:
            for rel in b["path"]:
                for name, folder, regular in entries(rel):
                    if folder and not rel and name.startswith("."):
                        continue
                    if folder or regular:
                        rows.append((f"{rel}/{name}" if rel else name, folder))
                    if len(rows) >= batch_rows:
                        yield pd.DataFrame(rows, columns=["path", "is_folder"])
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["path", "is_folder"])

    return run


def tree_inventory(spark: SparkSession, root: str, parallelism: int | None = None, batch_rows: int = 50_000) -> DataFrame:
    """``DF(path)`` of every regular file below ``root`` (relative paths).

    ``parallelism`` is the number of tasks that a level's folders are dealt to
    (the cluster's default parallelism unless given)."""
    root = root if ":" in root.split("/")[0] else os.path.abspath(root)
    tasks = parallelism or spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([("",)], "path string")
    files = spark.createDataFrame([], "path string")
    while True:
        level = freeze(folders.repartition(tasks, "path").mapInPandas(_lister(root, batch_rows), "path string, is_folder boolean"), "tree")
        files = files.union(level.where(~F.col("is_folder")).select("path"))
        folders = level.where("is_folder").select("path")
        if folders.isEmpty():
            return files


def _maker(root: str, known_folders: int = 100_000):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: set[str] = set()  # a folder is made once a task, not once a file
        for b in batches:
            for path in b["path"]:
                target = os.path.join(root, path)
                folder = os.path.dirname(target)
                if folder not in made:
                    os.makedirs(folder, exist_ok=True)
                    if len(made) >= known_folders:
                        made.clear()
                    made.add(folder)
                os.close(os.open(target, os.O_CREAT | os.O_WRONLY, 0o666))
            yield pd.DataFrame({"n": [len(b)]})

    return run


def make_tree(paths: DataFrame, root: str) -> int:
    """Create an empty file for every path of ``DF(path)`` below a mounted
    ``root``, in tasks; returns how many paths were given."""
    mounted = mounted_path(root)
    if mounted is None:
        raise ValueError(f"{root} is not on a mounted file system")
    return paths.select("path").mapInPandas(_maker(mounted), "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
