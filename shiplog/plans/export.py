"""End-to-end table export: control file + ordered enclosed data.

The control file describes the data files; loading them back (``load``)
applies the same rules the control file states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from shiplog.operators.catalog import columns_of, loader_spec
from shiplog.sources import enclosed
from shiplog.sources.catalog import column_catalog


def export_table(
    df: DataFrame,
    table: str,
    order_cols: Sequence[str | Column],
    out_dir: str,
    catalog: DataFrame | None = None,
) -> dict[str, object]:
    """Write ``<out_dir>/spec`` (control file) and ``<out_dir>/data``.

    Returns the rejected (ambiguous) rows and the spec frame.
    """
    spark = df.sparkSession
    # measured lengths: a string without a length clause would be cut at the
    # loader's default
    cat = catalog if catalog is not None else column_catalog(spark, {table: df}, measure_lengths=True)
    spec = loader_spec(columns_of(cat, table))
    enclosed.write_loader_spec(spec, f"{out_dir}/spec")
    rejects = enclosed.export_enclosed(df, order_cols, f"{out_dir}/data", table, cat)
    return {"rejects": rejects, "spec": spec}


def load_table(
    spark: SparkSession, out_dir: str, df_schema: T.StructType, table: str, catalog: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load ``<out_dir>/data`` back with the exported columns' types."""
    probe = spark.createDataFrame([], df_schema)
    cols = enclosed.export_columns(probe, catalog, table)
    schema = T.StructType([df_schema[c] for c, _ in cols])
    return enclosed.load_enclosed(spark, f"{out_dir}/data", schema)
