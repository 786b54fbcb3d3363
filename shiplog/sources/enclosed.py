"""Enclosed-delimited export and load (S5, S6, S7, with P13-P15).

Export: the catalog decides which columns go out (P10/P11) and how each is
rendered (P14); rows are written in the caller's order by a global sort, so
part-file name order is row order. Values that cannot be written without
ambiguity (the format has no escape) are returned as rejects instead.

Load: records are split on the multi-character terminator by the text
source (splittable, so large files are read in parallel), fields are taken
apart with one regular expression and cast to the target types; rows with a
value that does not cast go to the bad side, blank records to the discard
side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog.functions.text import (
    FIELD_SEP,
    RECORD_END,
    ambiguous,
    enclosed_parts,
    enclosed_record,
    field_at,
    render_text,
)
from shiplog.operators.catalog import columns_of, visible_columns
from shiplog.session import freeze
from shiplog.sources.catalog import column_catalog

RECORD_TAIL = "<eor>"


def export_columns(df: DataFrame, catalog: DataFrame | None, table: str) -> list[tuple[str, str | None]]:
    """(column name, declared type) of the exportable columns in column order.

    The catalog is metadata bounded by the column count, so collecting its
    rows for one table is safe.
    """
    cat = catalog if catalog is not None else column_catalog(df.sparkSession, {table: df})
    rows = (
        visible_columns(columns_of(cat, table))
        .select("column_name", "data_type", "column_id")
        .orderBy("column_id")
        .collect()
    )
    by_upper = {f.name.upper(): f.name for f in df.schema.fields}
    return [(by_upper[r["column_name"]], r["data_type"]) for r in rows if r["column_name"] in by_upper]


def rendered_fields(df: DataFrame, cols: Sequence[tuple[str, str | None]]) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [render_text(F.col(c), types[c], declared) for c, declared in cols]


def record_line(df: DataFrame, catalog: DataFrame | None, table: str) -> Column:
    """One record as written, ending with a tab and ``<eor>``."""
    cols = export_columns(df, catalog, table)
    return F.concat(enclosed_record(rendered_fields(df, cols)), F.lit(FIELD_SEP + RECORD_TAIL))


def export_enclosed(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    path: str,
    table: str,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """Write ``df`` in ``order_cols`` order; returns the rejected rows.

    Rows with a value holding ``..@`` + tab or the record terminator are
    not written (they would not load back as they are).
    """
    cols = export_columns(df, catalog, table)
    # Only text can hold "..@<tab>" or the record terminator: numbers, dates
    # and timestamps render to digits and separators. So the check reads the
    # raw string columns and the records are rendered once, after the sort.
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = F.lit(False)
    for c, _ in cols:
        if isinstance(types[c], T.StringType):
            bad = bad | ambiguous(F.col(c))
    flagged = df.withColumn("_ambiguous", bad)
    body = F.concat(enclosed_record(rendered_fields(df, cols)), F.lit(FIELD_SEP)).alias("value")
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    (
        flagged.where(~F.col("_ambiguous"))
        .orderBy(*order)
        .select(body)
        .write.mode("overwrite")
        .option("lineSep", RECORD_END)
        .text(path)
    )
    return flagged.where(F.col("_ambiguous")).drop("_ambiguous")


def _typed(text: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return text
    if isinstance(dt, T.TimestampNTZType):
        # a zone suffix (+hh/mm) is dropped for zone-less targets
        return F.regexp_replace(text, r" [+-]\d{2}/\d{2}\z", "").try_cast(dt)
    if isinstance(dt, T.TimestampType):
        iso = F.regexp_replace(text, r" ([+-]\d{2})/(\d{2})\z", "$1:$2")
        return iso.try_cast(dt)
    if isinstance(dt, T.DateType):
        return F.substring_index(text, " ", 1).try_cast(dt)
    return text.try_cast(dt)


def skip_records(raw: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` records in file order (file name, then position).

    The order key is taken at the scan, before anything can reorder rows:
    file path, start of the file split and the position inside the scan
    task (``monotonically_increasing_id``). The records are then numbered
    with the skew-safe global numbering and the first ``n`` dropped.
    """
    from shiplog.operators.numbering import number_within

    keyed = raw.select(
        "value",
        # part files by number: names of six digits sort before those of five
        F.regexp_extract("_metadata.file_path", r"part-(\d+)", 1).try_cast("bigint").alias("_part"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    numbered = number_within(keyed, [], ["_part", "_file", "_block", "_pos"], "_record_no")
    return numbered.where(F.col("_record_no") > n).select("value")


def load_enclosed(
    spark: SparkSession, path: str, schema: T.StructType, skip: int = 0
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(good, bad, discard)`` from files written by ``export_enclosed``;
    each side reads the files when it is used (:func:`load_enclosed_into` reads
    them once).

    Missing trailing fields are null, empty fields are null, text after the
    last expected field is ignored. ``skip`` drops the first records in file
    order. ``bad`` keeps the raw record for every row with a value that does
    not convert; ``discard`` holds blank records.
    """
    return _sides(_staged(spark, path, schema, skip), schema)


def _staged(spark: SparkSession, path: str, schema: T.StructType, skip: int) -> DataFrame:
    """Every record, its typed fields, and whether it failed or is blank."""
    raw = spark.read.option("lineSep", RECORD_END).text(path)
    if skip:
        raw = skip_records(raw, skip)
    return _staged_records(raw, schema).select("_record", *[f.name for f in schema.fields], "_failed", "_blank")


def _staged_records(raw: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """As ``_staged`` from the records ``raw`` (value), with the columns
    ``keep`` and, per field, whether it did not convert (``_w<i>``)."""
    n = len(schema.fields)
    # One regex pass per record, then one pass to unwrap the fields. Each
    # one-element explode is a barrier: the good/bad filters below cannot be
    # pushed under it, so no expression is re-evaluated per reference (that
    # would also blow up the generated code for wide tables).
    parts = raw.select(
        *keep,
        F.col("value").alias("_record"),
        F.explode(F.array(enclosed_parts(F.col("value")))).alias("_parts"),
    )
    unwrapped = F.struct(*[field_at(F.col("_parts"), i).alias(f"_f{i}") for i in range(n)])
    fields = parts.select(*keep, "_record", F.explode(F.array(unwrapped)).alias("_fs")).select(*keep, "_record", "_fs.*")
    typed = fields.select(
        "*", *[_typed(F.col(f"_f{i}"), fld.dataType).alias(f"_t{i}") for i, fld in enumerate(schema.fields)]
    )
    wrong = [F.col(f"_f{i}").isNotNull() & F.col(f"_t{i}").isNull() for i in range(n)]
    failed = F.lit(False)
    blank = F.lit(True)
    for i in range(n):
        failed = failed | wrong[i]
        blank = blank & F.col(f"_f{i}").isNull()
    return typed.select(
        *keep,
        "_record",
        *[F.col(f"_t{i}").alias(fld.name) for i, fld in enumerate(schema.fields)],
        failed.alias("_failed"),
        blank.alias("_blank"),
        *[w.alias(f"_w{i}") for i, w in enumerate(wrong)],
    )


def _sides(staged: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame, DataFrame]:
    good = staged.where(~F.col("_failed") & ~F.col("_blank")).select(*[f.name for f in schema.fields])
    bad = staged.where(F.col("_failed")).select("_record")
    discard = staged.where(F.col("_blank") & ~F.col("_failed")).select("_record")
    return good, bad, discard


def load_enclosed_into(
    spark: SparkSession, path: str, schema: T.StructType, target: str, skip: int = 0, bad_path: str | None = None, discard_path: str | None = None
) -> dict[str, DataFrame]:
    """S6 with the target replaced: good rows overwrite the parquet target,
    raw bad and blank records the text files beside it (``.bad`` and
    ``.discard`` unless other paths are given). The three are written from one
    stored pass over the files."""
    staged = freeze(_staged(spark, path, schema, skip), "load")
    out = {"bad": bad_path or f"{target}.bad", "discard": discard_path or f"{target}.discard"}
    good, bad, discard = _sides(staged, schema)
    good.write.mode("overwrite").parquet(target)
    for name, side in (("bad", bad), ("discard", discard)):
        side.select("_record").write.mode("overwrite").option("lineSep", RECORD_END).text(out[name])
    read = {k: spark.read.option("lineSep", RECORD_END).text(p).withColumnRenamed("value", "_record") for k, p in out.items()}
    return {"good": spark.read.parquet(target), **read}


def write_loader_spec(spec: DataFrame, path: str) -> None:
    """One control-file folder per table, lines in ``line_no`` order."""
    (
        spec.repartition("table_name")
        .sortWithinPartitions("table_name", "line_no")
        .select("table_name", "line")
        .write.mode("overwrite")
        .partitionBy("table_name")
        .text(path)
    )
