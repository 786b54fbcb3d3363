import datetime as dt

from helpers import rows

from shiplog.operators import inventory as inv


def _inv(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_filter_rules(spark):
    paths = [
        "./_x/a.sql",  # kept: underscore names are fine
        "./a/.b/c.sql",  # kept: only the first component matters
        "./.a/b.sql",  # dropped: hidden top folder
        "./top.sql",  # dropped: no folder above
        "a/x.SQL.TMP",  # kept: rules are case-sensitive
        "a/x.tmp",
        "a/x.log",
        "a/x.sql.~bak",
        "a/x.bak~",
        "a/1;deploy_repo.sql",
        "a/b/c.sql",
    ]
    out = rows(inv.filter_inventory(_inv(spark, paths)), "path")
    assert out == sorted([("_x/a.sql",), ("a/.b/c.sql",), ("a/x.SQL.TMP",), ("a/b/c.sql",)])


def test_parse_rules(spark):
    paths = [
        "r/20240105-0730;fix things/0;t.sql",  # number 0 rejected
        "r/20240105-0730;fix things/0007;t.sql",  # leading zeros
        "r/20240105-0730/12;t_1.pkg.body.sql",  # extension with dots, no comment
        "r/20240105-0730/12;t",  # no extension
        "r/20241399-0000/1;t.sql",  # bad date
        "r/20240310-0230/1;t.sql",  # inside a daylight-saving gap elsewhere: unchanged
        "r/notapackage/1;t.sql",
    ]
    parsed = {r["path"]: r for r in inv.parse_inventory(_inv(spark, paths)).collect()}
    assert parsed["r/20240105-0730;fix things/0;t.sql"]["reject_reason"] == "bad script number"
    ok = parsed["r/20240105-0730;fix things/0007;t.sql"]
    assert ok["reject_reason"] is None and ok["script_no"] == 7 and ok["target_id"] == "t"
    assert ok["package_comment"] == "fix things"
    assert ok["package_ts"] == dt.datetime(2024, 1, 5, 7, 30)
    ext = parsed["r/20240105-0730/12;t_1.pkg.body.sql"]
    assert ext["extension"] == "pkg.body.sql" and ext["package_comment"] is None
    assert parsed["r/20240105-0730/12;t"]["reject_reason"] == "bad script name"
    assert parsed["r/20241399-0000/1;t.sql"]["reject_reason"] == "bad package folder"
    assert parsed["r/20240310-0230/1;t.sql"]["package_ts"] == dt.datetime(2024, 3, 10, 2, 30)
    assert parsed["r/notapackage/1;t.sql"]["reject_reason"] == "bad package folder"


def test_counts_match_survey(spark):
    from shiplog.plans import derived
    from shiplog.session import read_table

    raw = derived.inventory_from_events(read_table(spark, "/root/testdata/sf0.01", "events"))
    kept = inv.filter_inventory(raw)
    good, bad = inv.split_valid(inv.parse_inventory(kept))
    assert kept.count() == 6765
    assert bad.count() == 407


def test_parse_package_and_script_alone(spark):
    df = _inv(spark, ["r/20240105-0730;c/0007;t.sql", "r/bad/0;t.sql"])
    pk = {r["path"]: r["package_ts"] for r in inv.parse_package(df).collect()}
    assert pk["r/bad/0;t.sql"] is None and pk["r/20240105-0730;c/0007;t.sql"] is not None
    sc = {r["path"]: (r["script_no"], r["target_id"]) for r in inv.parse_script(df).collect()}
    assert sc == {"r/20240105-0730;c/0007;t.sql": (7, "t"), "r/bad/0;t.sql": (None, None)}
