from shiplog.plans.plugins import plugin_order


def _touch(root, names):
    for n in names:
        p = root / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("echo hi\n")


def test_plugin_order(spark, tmp_path):
    g, loc = tmp_path / "global-plugins", tmp_path / "local"
    _touch(g, ["pre-10-b.sh", "pre-2-a.sh", "post-1.sh", "pre-x.sh"])
    _touch(loc, ["pre-1.sh", "notes.txt"])
    got = [(r["layer"], r["path"].rsplit("/", 1)[1]) for r in plugin_order(spark, str(g), str(loc)).orderBy("ord").collect()]
    # a dash in the folder name does not shift the order
    assert got == [(0, "pre-x.sh"), (0, "pre-2-a.sh"), (0, "pre-10-b.sh"), (1, "pre-1.sh")]
    same = plugin_order(spark, str(loc), str(loc), "pre").collect()
    assert [r["layer"] for r in same] == [1]
    post = plugin_order(spark, str(g), None, "post").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in post] == ["post-1.sh"]
