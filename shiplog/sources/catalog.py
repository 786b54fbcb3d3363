"""Column catalog of many tables at once.

The catalog is metadata (one row per column), built on the driver from the
DataFrames' schemas; its size is bounded by the column count, never by data.
Optionally the byte length of string columns is measured from the data (one
lazy job over all tables).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("column_id", T.IntegerType(), False),
        T.StructField("data_type", T.StringType(), True),
        T.StructField("data_type_owner", T.StringType(), True),
        T.StructField("data_length", T.IntegerType(), True),
        T.StructField("virtual_column", T.StringType(), True),
        T.StructField("hidden_column", T.StringType(), True),
        T.StructField("spark_type", T.StringType(), False),
    ]
)

_CHAR_META = "__CHAR_VARCHAR_TYPE_STRING"


def catalog_type(field: T.StructField) -> tuple[str | None, int | None]:
    """Catalog type name and declared length of a Spark field.

    Types the export cannot carry (arrays, maps, structs) get no type name;
    the ``NOT IN`` type filter then drops them, as it drops any unknown type.
    """
    dt = field.dataType
    declared = (field.metadata or {}).get(_CHAR_META, "")
    if isinstance(dt, T.StringType):
        if declared.startswith("char("):
            return "CHAR", int(declared[5:-1])
        if declared.startswith("varchar("):
            return "VARCHAR2", int(declared[8:-1])
        return "VARCHAR2", None
    if isinstance(dt, T.CharType):
        return "CHAR", dt.length
    if isinstance(dt, T.VarcharType):
        return "VARCHAR2", dt.length
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return "NUMBER", None
    if isinstance(dt, T.DateType):
        return "DATE", None
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP(6)", None
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP(6) WITH TIME ZONE", None
    if isinstance(dt, T.BinaryType):
        return "BLOB", None
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN", None
    return None, None


def _per_column(tables: Mapping[str, DataFrame], measure, wanted, name: str) -> DataFrame:
    """(table_name, column_name, name): one measure of each wanted column, one
    partial aggregation per table, all tables in one job."""
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame([], f"table_name string, column_name string, {name} bigint")
    for table, df in tables.items():
        fields = [f.name for f in df.schema.fields if wanted(f)]
        if not fields:
            continue
        row = df.agg(*[measure(F.col(f"`{c}`")).cast("bigint").alias(c) for c in fields])
        cells = [F.struct(F.lit(c.upper()).alias("column_name"), F.col(f"`{c}`").alias(name)) for c in fields]
        out = out.unionByName(row.select(F.lit(table.upper()).alias("table_name"), F.inline(F.array(*cells))))
    return out


def measured_lengths(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Longest value in bytes of every string column (lazy)."""
    return _per_column(tables, lambda c: F.max(F.octet_length(c)), lambda f: isinstance(f.dataType, T.StringType), "max_bytes")


def value_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values that are not null in every column (lazy)."""
    return _per_column(tables, F.count, lambda f: True, "n_values")


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` in which counts come from Parquet footers
    (settings of the given session stay as they are)."""
    beside = spark.newSession()
    beside.conf.set("spark.sql.sources.useV1SourceList", "")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside


def _flat(dt: T.DataType) -> bool:
    return not isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _one_leaf(dt: T.DataType) -> bool:
    return _flat(dt) or (isinstance(dt, T.ArrayType) and _one_leaf(dt.elementType))


def footer_plan(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, column_name, n_values) of the flat columns of Parquet
    tables, summed from row counts and null counts in the files' footers."""
    beside = _footer_session(spark)
    tables = {}
    for table, path in paths.items():
        df = beside.read.option("recursiveFileLookup", "true").parquet(path)  # without partition columns
        # footers count by leaf: a column behind a struct or a map is not at its own place
        names = []
        for f in df.schema.fields:
            if not _one_leaf(f.dataType):
                break
            if _flat(f.dataType):
                names.append(f.name)
        tables[table] = df.select(*[F.col(f"`{c}`") for c in names])
    return value_counts(tables)


def footer_value_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Values that are not null in every column of Parquet tables.

    Flat columns take part without a column being read: tasks read footers and
    Spark sums their row counts less their null counts. Footers say nothing of
    nulls of an array, a map or a struct as a whole, so these columns (and
    columns behind a map or struct, and partition columns) are counted by a scan
    of themselves alone. A file without null counts in its footer fails the job: count
    such tables by :func:`value_counts`. The result is metadata, a row per column.
    """
    if not paths:
        return spark.createDataFrame([], "table_name string, column_name string, n_values bigint")
    # a table without any row group sums to no value, which is read as null or -1
    footers = [(t, c, max(n or 0, 0)) for t, c, n in footer_plan(spark, paths).collect()]
    known = {(t, c) for t, c, _ in footers}
    rest = {}
    for table, path in paths.items():
        df = spark.read.parquet(path)
        left = [c for c in df.columns if (table.upper(), c.upper()) not in known]
        rest[table] = df.select(*[F.col(f"`{c}`") for c in left])
    out = spark.createDataFrame(footers, "table_name string, column_name string, n_values bigint")
    return out.unionByName(value_counts({t: df for t, df in rest.items() if df.columns} or {"": spark.range(0).select()}))


def column_catalog(
    spark: SparkSession, tables: Mapping[str, DataFrame], measure_lengths: bool = False
) -> DataFrame:
    """One row per column of every table: upper-case names, 1-based
    ``column_id`` in schema order, catalog type and the Spark type.

    Spark strings have no declared length. With ``measure_lengths`` the
    length of a string column without one is the longest value in bytes,
    measured from the data, so a loader spec made from the catalog accepts
    every row.
    """
    rows = []
    for name, df in tables.items():
        for pos, field in enumerate(df.schema.fields, start=1):
            type_name, length = catalog_type(field)
            rows.append(
                (
                    name.upper(),
                    field.name.upper(),
                    pos,
                    type_name,
                    None,
                    length,
                    None,
                    None,
                    field.dataType.simpleString(),
                )
            )
    cat = spark.createDataFrame(rows, CATALOG_SCHEMA)
    if not measure_lengths or not tables:
        return cat
    sized = cat.join(measured_lengths(tables), ["table_name", "column_name"], "left")
    length = F.coalesce("data_length", F.col("max_bytes").cast("int")).alias("data_length")
    return sized.select(*[length if c == "data_length" else c for c in CATALOG_SCHEMA.names])
