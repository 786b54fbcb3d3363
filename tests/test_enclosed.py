import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog.functions.text import render_text, split_enclosed
from shiplog.session import scratch_path
from shiplog.sources import enclosed


def _fields(spark, record, n):
    df = spark.createDataFrame([(record,)], "value string")
    return list(df.select(*split_enclosed(F.col("value"), n)).collect()[0])


def test_split_edge_cases(spark):
    assert _fields(spark, "@..a\tb..@\t@..c\nd..@\t", 2) == ["a\tb", "c\nd"]
    assert _fields(spark, "@..a....@\t", 1) == ["a.."]
    assert _fields(spark, "@..p..@q..@\t", 1) == ["p..@q"]
    assert _fields(spark, "plain\t@..x..@\t", 2) == ["plain", "x"]
    assert _fields(spark, "@..x..@\t", 3) == ["x", None, None]
    assert _fields(spark, "@....@\t@..y..@\tignored", 2) == [None, "y"]


def test_render_formats(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5, 120000), 0.5, 7)], "ts timestamp_ntz, x double, n bigint"
    )
    r = df.select(
        render_text(F.col("ts"), T.TimestampNTZType()).alias("a"),
        render_text(F.col("ts"), T.TimestampNTZType(), "DATE").alias("b"),
        render_text(F.col("ts"), T.TimestampNTZType(), "TIMESTAMP(6) WITH TIME ZONE").alias("c"),
        render_text(F.col("x"), T.DoubleType()).alias("d"),
        render_text(F.col("n"), T.LongType()).alias("e"),
    ).collect()[0]
    assert r["a"] == "2024-01-02 03:04:05.120000000"
    assert r["b"] == "2024-01-02 03:04:05"
    assert r["c"] == "2024-01-02 03:04:05.120000000 +00/00"
    assert (r["d"], r["e"]) == ("0.5", "7")


def test_round_trip_bad_and_ambiguous(spark):
    rows = [
        (1, "tab\there", dt.datetime(2024, 1, 1, 0, 0, 0, 1), 1.25),
        (2, "", None, None),
        (3, "line\nbreak", dt.datetime(2023, 12, 31, 23, 59, 59), -3.0),
        (4, "bad..@\tvalue", None, 0.0),
    ]
    df = spark.createDataFrame(rows, "id bigint, s string, ts timestamp_ntz, x double")
    path = scratch_path(spark, "test-enclosed")
    rejects = enclosed.export_enclosed(df, ["id"], path, "T")
    assert [r["id"] for r in rejects.collect()] == [4]
    good, bad, discard = enclosed.load_enclosed(spark, path, df.schema)
    got = sorted(tuple(r) for r in good.collect())
    assert got == [
        (1, "tab\there", dt.datetime(2024, 1, 1, 0, 0, 0, 1), 1.25),
        (2, None, None, None),
        (3, "line\nbreak", dt.datetime(2023, 12, 31, 23, 59, 59), -3.0),
    ]
    assert bad.count() == 0 and discard.count() == 0
    # a value that does not convert goes to the bad side; a blank record is discarded
    extra = scratch_path(spark, "test-enclosed-bad")
    spark.createDataFrame([("@..x..@\t@..a..@\t",), ("@....@\t\t",)], "value string").write.option(
        "lineSep", "<eor>\n"
    ).text(extra)
    g2, b2, d2 = enclosed.load_enclosed(spark, extra, T.StructType([df.schema["id"], df.schema["s"]]))
    assert g2.count() == 0 and b2.count() == 1 and d2.count() == 1


def test_loader_spec_writer(spark, tmp_path):
    from shiplog.operators.catalog import loader_spec
    from shiplog.sources.catalog import column_catalog

    df = spark.createDataFrame([], "a bigint, b string")
    out = str(tmp_path / "spec")
    enclosed.write_loader_spec(loader_spec(column_catalog(spark, {"t": df})), out)
    text = "".join(open(p).read() for p in sorted((tmp_path / "spec" / "table_name=T").glob("part-*")))
    assert "into table T\n" in text and "    a,\n    b    char(" not in text
    assert text.splitlines()[-1] == "begindata"


def test_zone_less_render_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 0, 5),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 is in the DST gap
        got = df.select(render_text(F.col("ts"), T.TimestampNTZType())).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == "2024-03-10 02:30:00.000005000"


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_TEXT = st.text(alphabet=st.sampled_from(list("ab.@<>eor\t\n\r| ;")), max_size=12)


@settings(max_examples=4, deadline=None, derandomize=True)
@given(st.lists(_TEXT, min_size=1, max_size=25))
def test_round_trip_property(spark, values):
    """Export -> load gives every writable value back (empty becomes null);
    values that cannot be written unambiguously are exactly the rejects."""
    from shiplog.functions.text import CLOSE, FIELD_SEP, RECORD_END

    df = spark.createDataFrame(list(enumerate(values)), "id bigint, s string")
    path = scratch_path(spark, "prop")
    rejects = {r["id"] for r in enclosed.export_enclosed(df, ["id"], path, "P").collect()}
    expect_bad = {i for i, v in enumerate(values) if (CLOSE + FIELD_SEP) in v or RECORD_END in v}
    assert rejects == expect_bad
    good, bad, _ = enclosed.load_enclosed(spark, path, df.schema)
    got = {r["id"]: r["s"] for r in good.collect()}
    want = {i: (v if v != "" else None) for i, v in enumerate(values) if i not in expect_bad}
    assert got == want and bad.count() == 0


def test_load_skips_first_records(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(1, 41)], "id bigint, s string").repartition(4)
    path = scratch_path(spark, "skip")
    enclosed.export_enclosed(df, ["id"], path, "S")
    good, _, _ = enclosed.load_enclosed(spark, path, df.schema, skip=5)
    assert sorted(r["id"] for r in good.collect()) == list(range(6, 41))


def test_round_trip_zoned_decimal_bool_date(spark):
    import decimal

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        rows = [
            (1, dt.datetime(2024, 7, 1, 12, 0, 0, 250000), decimal.Decimal("12.34"), True, dt.date(2024, 2, 29)),
            (2, None, None, None, None),
        ]
        df = spark.createDataFrame(rows, "id bigint, ts timestamp, amount decimal(18,2), flag boolean, d date")
        path = scratch_path(spark, "zoned")
        enclosed.export_enclosed(df, ["id"], path, "Z")
        text = spark.read.option("lineSep", "<eor>\n").text(path).collect()
        assert any("+02/00" in r["value"] for r in text)  # summer time offset, written as +hh/mm
        good, bad, _ = enclosed.load_enclosed(spark, path, df.schema)
        assert bad.count() == 0
        assert sorted(tuple(r) for r in good.collect()) == sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
