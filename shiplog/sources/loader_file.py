"""One self-contained loader file per table: control lines, then the data.

The rows are sorted once, straight into text part files whose name order is
the row order (:func:`shiplog.sources.enclosed.export_enclosed`). Their sizes
and the size of the control lines give every part its place in the file by
prefix sums. On a mounted file system the tasks then write their slices of at
most ``SLICE_BYTES`` at those places, into a file of the final size that gets
its name when all slices are in; a slice that is written again after a lost
task writes the same bytes. On a store with its own concatenation the parts
are joined there. No task holds or writes the whole file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog.operators.catalog import columns_of, loader_spec
from shiplog.session import freeze, mounted_path, scratch_path
from shiplog.sources.catalog import column_catalog
from shiplog.sources.enclosed import _sides, _staged_records, export_columns, export_enclosed
from shiplog.sources.records import numbered, read_records

SLICE_BYTES = 128 << 20
COPY_BYTES = 4 << 20


def _parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the part files in row order: one entry per file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    own = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in found]
    own = [(int(name.split("-")[1]), path, n) for name, path, n in own if name.startswith("part-")]
    return [(path, n) for _, path, n in sorted(own)]


def _writer(target: str):
    def run(batches):
        for batch in batches:
            done = []
            for source, lo, at, n in batch.itertuples(index=False):
                with open(source, "rb") as f, open(target, "r+b") as out:
                    f.seek(lo)
                    out.seek(at)
                    left = n
                    while left:
                        block = f.read(min(left, COPY_BYTES))
                        if not block:
                            raise OSError(f"{source} is shorter than planned")
                        out.write(block)
                        left -= len(block)
                    out.flush()
                    os.fsync(out.fileno())
                done.append(n)
            yield pd.DataFrame({"n": done}, dtype="int64")

    return run


def concatenate(spark: SparkSession, head: bytes, folder: str, path: str) -> int:
    """``path`` = ``head`` and the part files of ``folder`` in order; returns
    its size in bytes."""
    parts = [(p, n) for p, n in _parts(spark, folder) if n]
    places = list(accumulate((n for _, n in parts), initial=len(head)))
    target = mounted_path(path)
    if target is None:
        return _concatenate_in_store(spark, head, [p for p, _ in parts], path, places[-1])
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    building = f"{target}.{uuid.uuid4().hex}.tmp"
    with open(building, "wb") as f:
        f.write(head)
        f.truncate(places[-1])
    slices = [
        (mounted_path(p), lo, at + lo, min(SLICE_BYTES, n - lo)) for (p, n), at in zip(parts, places, strict=False) for lo in range(0, n, SLICE_BYTES)
    ]
    if slices:
        plan = spark.createDataFrame(slices, "source string, lo long, at long, n long").repartition(len(slices))
        written = plan.mapInPandas(_writer(building), "n long").agg(F.sum("n")).first()[0]
        if written != places[-1] - len(head):
            raise OSError(f"{path}: {written} of {places[-1] - len(head)} bytes written")
    os.replace(building, target)
    return places[-1]


def _concatenate_in_store(spark: SparkSession, head: bytes, parts: list[str], path: str, size: int) -> int:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(head))
    finally:
        out.close()
    own = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, p in enumerate(parts):
        own[i] = jvm.org.apache.hadoop.fs.Path(p)
    if parts:
        fs.concat(target, own)
    return size


def write_loader_file(df: DataFrame, order_cols: Sequence[str | Column], path: str, table: str, catalog: DataFrame | None = None) -> DataFrame:
    """Write ``path``: the table's control lines and its rows in ``order_cols``
    order; returns the rows that cannot be written without ambiguity.

    Without a catalog string lengths are measured, as a loader would cut longer
    values at its default length."""
    spark = df.sparkSession
    cat = catalog if catalog is not None else column_catalog(spark, {table: df}, measure_lengths=True)
    lines = loader_spec(columns_of(cat, table)).orderBy("line_no").select("line").collect()  # a line per column
    head = "".join(r["line"] + "\n" for r in lines).encode()
    parts = scratch_path(spark, "loader_parts")
    rejects = export_enclosed(df, order_cols, parts, table, cat)
    concatenate(spark, head, parts, path)
    return rejects


def load_records(records: DataFrame, schema: T.StructType, skip: int = 0) -> DataFrame:
    """Every record after the first ``skip`` with where it goes: record_no,
    ``start`` (its byte offset), ``side`` (good, bad, discard), ``reason`` and the typed
    columns.

    A record is bad if a field does not convert; the reason names the first
    such column. It is discarded if all its fields are empty. Missing trailing
    fields are null, more fields than columns are ignored."""
    placed = numbered(records)
    if skip:
        placed = placed.where(F.col("record_no") > skip)
    staged = _staged_records(placed.withColumnRenamed("record", "value"), schema, ["record_no", "file", "start"])
    wrong = [F.when(F.col(f"_w{i}"), F.lit(f"{f.name}: not {f.dataType.simpleString()}")) for i, f in enumerate(schema.fields)]
    side = F.when(F.col("_failed"), "bad").when(F.col("_blank"), "discard").otherwise("good")
    reason = F.when(F.col("_failed"), F.coalesce(*wrong)).when(F.col("_blank"), "no field is filled")
    return staged.select("record_no", "file", "start", side.alias("side"), reason.alias("reason"), "_record", *[f.name for f in schema.fields])


def read_loader_file(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records of a self-contained loader file, read by byte ranges."""
    return read_records(spark, path, self_contained=True, **options)


def load_loader_file(spark: SparkSession, path: str, df_schema: T.StructType, table: str, catalog: DataFrame, skip: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(good rows, bad records, blank records) of a self-contained file, with
    the exported columns' types; the file is read once and stored."""
    cols = export_columns(spark.createDataFrame([], df_schema), catalog, table)
    schema = T.StructType([df_schema[c] for c, _ in cols])
    staged = freeze(load_records(read_loader_file(spark, path), schema, skip), "load")
    flags = staged.withColumns({"_failed": F.col("side") == "bad", "_blank": F.col("side") == "discard"})
    return _sides(flags, schema)
