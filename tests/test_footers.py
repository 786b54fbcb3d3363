"""Value counts from file footers."""

from helpers import SF_SMALL, rows

from shiplog.sources import catalog


def same(spark, path):
    got = rows(catalog.footer_value_counts(spark, {"t": path}))
    assert got == rows(catalog.value_counts({"t": spark.read.parquet(path)}))
    return {c: n for _, c, n in got}


def test_no_column_is_read(spark):
    plan = catalog.footer_plan(spark, {"lineitem": f"{SF_SMALL}/lineitem.parquet"})._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(l_orderkey)" in plan
    assert "Scan parquet" not in plan.replace("BatchScan parquet", "")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_nulls_nested_and_partition_columns(spark, tmp_path):
    df = spark.range(40).selectExpr(
        "if(id % 4 = 0, null, id) a",
        "if(id % 5 = 0, null, if(id % 3 = 0, array(), array(id, null))) l",
        "if(id % 8 = 0, null, cast(id as string)) s",
        "if(id % 10 = 0, null, named_struct('x', if(id % 2 = 0, null, id), 'y', id)) n",
        "cast(null as double) z",
        "if(id % 7 = 0, null, id) behind",
        "if(id % 3 = 0, null, id % 3) p",
    )
    df.repartition(3).write.partitionBy("p").parquet(str(tmp_path / "t"))
    counts = same(spark, str(tmp_path / "t"))
    assert counts == {"A": 30, "L": 32, "S": 35, "N": 36, "Z": 0, "BEHIND": 34, "P": 26}


def test_empty_table_and_odd_names(spark, tmp_path):
    spark.range(0).selectExpr("id", "id `a b`").write.parquet(str(tmp_path / "e"))
    assert same(spark, str(tmp_path / "e")) == {"ID": 0, "A B": 0}
    assert catalog.footer_value_counts(spark, {}).count() == 0
