from pyspark.sql import functions as F

from shiplog.operators import catalog as cat_ops
from shiplog.sources.catalog import column_catalog

SCHEMA = (
    "table_name string, column_name string, column_id int, data_type string, data_type_owner string, "
    "data_length int, virtual_column string, hidden_column string"
)


def test_visible_null_flags(spark):
    rows = [
        ("T", "A", 1, "NUMBER", None, 10, None, None),  # kept: unknown flags
        ("T", "B", 2, "NUMBER", None, 10, "YES", None),  # virtual
        ("T", "C", 3, "NUMBER", None, 10, "NO", "YES"),  # hidden
        ("T", "D", 4, "XMLTYPE", "SYS", 10, "YES", "NO"),  # virtual system XML: kept
        ("T", "E", 5, "CLOB", None, 10, "NO", "NO"),  # LOB
        ("T", "F", 6, None, None, 10, "NO", "NO"),  # null type: dropped
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["column_name"] for r in cat_ops.visible_columns(df).collect()) == ["A", "D"]


def test_loader_types_and_spec(spark):
    types = ["CHAR", "NCHAR", "VARCHAR2", "NVARCHAR2", "DATE", "TIMESTAMP", "TIMESTAMP(6)",
             "TIMESTAMP(6) WITH TIME ZONE", "TIMESTAMP(6) WITH LOCAL TIME ZONE", "XMLTYPE", "NUMBER"]
    rows = [("T", f"C{i}", i + 1, t, "SYS" if t == "XMLTYPE" else None, 5, None, None) for i, t in enumerate(types)]
    spec = cat_ops.loader_spec(spark.createDataFrame(rows, SCHEMA)).orderBy("line_no").collect()
    lines = [r["line"] for r in spec]
    body = lines[len(cat_ops.SPEC_HEADER) : -len(cat_ops.SPEC_FOOTER)]
    assert body == [
        "    c0    char(5),",
        "    c1    char(10),",
        "    c2    char(5),",
        "    c3    char(10),",
        "    c4    char(64),",
        "    c5    char(64),",
        "    c6,",
        "    c7    char(64),",
        "    c8,",
        "    c9    char(4000),",
        "    c10",
    ]
    assert "into table T" in lines
    assert [r["line_no"] for r in spec] == list(range(1, len(lines) + 1))


def test_catalog_from_schema(spark):
    df = spark.createDataFrame([], "a bigint, b string, c timestamp_ntz, d array<int>")
    got = [(r["column_name"], r["column_id"], r["data_type"]) for r in column_catalog(spark, {"t": df}).collect()]
    assert got == [("A", 1, "NUMBER"), ("B", 2, "VARCHAR2"), ("C", 3, "TIMESTAMP(6)"), ("D", 4, None)]


def test_column_list_equals_record(spark):
    """The projection text renders what ``record_line`` writes, nulls too."""
    import datetime as dt

    from shiplog.sources.enclosed import record_line

    rows = [(1, "x\ty", dt.datetime(2024, 1, 2, 3, 4, 5, 678), dt.date(2024, 1, 2), 1.5, True), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a bigint, b string, c timestamp_ntz, d date, e double, f boolean").withColumn("g", F.col("c").cast("timestamp"))
    for declared in (None, "DATE", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE"):
        cat = column_catalog(spark, {"t": df})
        if declared:
            cat = cat.withColumn("data_type", F.when(F.col("column_name").isin("C", "D", "G"), F.lit(declared)).otherwise(F.col("data_type")))
        text = cat_ops.column_list(cat).first()["column_list"]
        for r in df.select((F.concat(F.expr(text), F.lit("\t<eor>"))).alias("x"), record_line(df, cat, "t").alias("y")).collect():
            assert r["x"] == r["y"]


def test_is_last_and_exclude_lobs(spark):
    rows = [("T", "A", 1, "NUMBER", None, 1, None, None), ("T", "B", 2, "BLOB", None, 1, None, None), ("U", "C", 1, None, None, 1, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["column_name"] for r in cat_ops.exclude_lobs(df).collect()) == ["A"]
    last = {r["column_name"]: r["is_last"] for r in cat_ops.is_last(df).collect()}
    assert last == {"A": False, "B": True, "C": True}
