import datetime as dt
import glob
import os

from shiplog.plans.export import export_table, load_table
from shiplog.session import scratch_path
from shiplog.sources.catalog import column_catalog
from shiplog.sources.enclosed import load_enclosed_into


def test_export_table_spec_and_data(spark):
    df = spark.createDataFrame(
        [(2, "b\tx", dt.datetime(2024, 1, 2)), (1, "a", None)], "id bigint, name string, ts timestamp_ntz"
    )
    cat = column_catalog(spark, {"t": df}, measure_lengths=True)
    out = scratch_path(spark, "export-plan")
    res = export_table(df, "T", ["id"], out, cat)
    assert res["rejects"].count() == 0
    spec_dir = out.replace("file:", "") + "/spec/table_name=T"
    spec = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(spec_dir, "part-*"))))
    assert "    name    char(3)," in spec  # measured: "b\tx" is 3 bytes
    data_dir = out.replace("file:", "") + "/data"
    text = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(data_dir, "part-*"))))
    assert text.index("@..1..@") < text.index("@..2..@")  # file order is row order
    good, bad, discard = load_table(spark, out, df.schema, "T", cat)
    assert sorted(tuple(r) for r in good.collect()) == [(1, "a", None), (2, "b\tx", dt.datetime(2024, 1, 2))]
    target = scratch_path(spark, "export-target")
    loaded = load_enclosed_into(spark, out + "/data", df.schema, target)
    assert loaded["good"].count() == 2 and loaded["bad"].count() == 0
