import os

from pyspark.sql import functions as F

from shiplog.sources import ledger_store

# executions as an older writer produces them (no started_at): stored as null
EXEC7 = (
    "app_id string, id_run bigint, id_script_execution bigint, id_script bigint, "
    "num_order bigint, target_id string, rc bigint"
)
from shiplog.sources.execution_list import parse_execution_lines, read_execution_list
from shiplog.sources.tree import tree_inventory


def test_tree_inventory(spark, tmp_path):
    root = tmp_path / "src"
    for rel, body in [
        ("a/20240101-0000/1;t.sql", "x"),
        ("a/20240101-0000/_x.sql", "x"),
        ("a/20240101-0000/.x.sql", "x"),
        ("a/empty.sql", ""),
        ("_u/2;t.sql", "x"),
        (".hidden/3;t.sql", "x"),
        ("top.sql", "x"),
    ]:
        p = root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(body)
    os.symlink(root / "top.sql", root / "a" / "link.sql")
    got = sorted(r["path"] for r in tree_inventory(spark, str(root), parallelism=2).collect())
    assert got == sorted(
        ["a/20240101-0000/1;t.sql", "a/20240101-0000/_x.sql", "a/20240101-0000/.x.sql", "a/empty.sql", "_u/2;t.sql", "top.sql"]
    )


def test_execution_list_rules(spark, tmp_path):
    p = tmp_path / "list.txt"
    p.write_bytes(
        b"1|2|3|4|t|f|a.sql|info\r"  # CR line end
        b"|skipped|x\n"  # empty first field
        b"5|6|7|8|t|f|b.sql\n"  # 7 fields
        b"9|10|11|12|t|f|c.sql|x|y\n"  # 9 fields: last keeps the rest
        b"13|14|15|16|t|f|d.sql|z|\n"  # trailing pipe dropped
        b"17|18|19|20|t|f|e.sql|"  # no final newline: kept
    )
    got = {r["id_script_execution"]: r["add_info"] for r in read_execution_list(spark, str(p)).collect()}
    assert got == {1: "info", 5: None, 9: "x|y", 13: "z", 17: None}


def test_parse_lines_types(spark):
    from shiplog.sources.execution_list import split_execution_lines

    df = spark.createDataFrame([("x|2|3|4|t|f|g|",)], "value string")
    assert parse_execution_lines(df).collect() == []
    assert [r["line"] for r in split_execution_lines(df)[1].collect()] == ["x|2|3|4|t|f|g|"]
    df = spark.createDataFrame([("1|2|3|4|t|f|g|" + x,) for x in ("a|b|", "x||", "y|", "|", "")], "value string")
    assert [r["add_info"] for r in parse_execution_lines(df).collect()] == ["a|b|", "x||", "y", None, None]


def test_ledger_versions(spark, tmp_path):
    root = str(tmp_path / "ledger")
    assert ledger_store.latest_version(spark, root) is None
    scripts = spark.createDataFrame(
        [("a", 1, "f", "1;t.sql", None, None, 1, "t", False), ("b", 1, "f", "1;t.sql", None, None, 1, "t", False)],
        ledger_store.SCRIPTS_DDL,
    )
    execs = spark.createDataFrame([("a", 1, 1000000001, 1, 1, "t", None)], EXEC7)
    assert ledger_store.write_ledger(spark, root, {"scripts": scripts, "executions": execs}) == 1
    # an outcome: the same execution with a return code, as version 2
    done = spark.createDataFrame([("a", 1, 1000000001, 1, 1, "t", 0)], EXEC7)
    assert ledger_store.write_ledger(spark, root, {"executions": done}) == 2
    # rows written without a commit marker (a failed commit) stay invisible
    scripts.withColumn("v", F.lit(3)).write.mode("append").partitionBy("v", "app_id").parquet(root + "/scripts")
    assert ledger_store.latest_version(spark, root) == 2
    now = ledger_store.read_ledger(spark, root)
    assert now["scripts"].count() == 2
    assert [r["rc"] for r in now["executions"].collect()] == [0]
    before = ledger_store.read_ledger(spark, root, as_of=1)
    assert [r["rc"] for r in before["executions"].collect()] == [None]
    back = ledger_store.read_ledger(spark, root, app_id="a")
    assert [r["app_id"] for r in back["scripts"].collect()] == ["a"]
    # the next commit skips the number the failed commit used
    assert ledger_store.write_ledger(spark, root, {}) == 4


def test_ledger_compaction(spark, tmp_path):
    root = str(tmp_path / "ledger-c")
    execs = spark.createDataFrame(
        [("a", 1, 1000000001, 1, 1, "t", None), ("a", 1, 1000000002, 2, 2, "t", None)], EXEC7
    )
    ledger_store.write_ledger(spark, root, {"executions": execs})
    done = spark.createDataFrame([("a", 1, 1000000001, 1, 1, "t", 0)], EXEC7)
    ledger_store.write_ledger(spark, root, {"executions": done})
    before = sorted((r["id_script_execution"], r["rc"]) for r in ledger_store.read_ledger(spark, root)["executions"].collect())
    base = ledger_store.compact(spark, root, prune=True)
    assert base == 3
    assert not os.path.exists(os.path.join(root, "executions", "v=1"))
    after = sorted((r["id_script_execution"], r["rc"]) for r in ledger_store.read_ledger(spark, root)["executions"].collect())
    assert before == after == [(1000000001, 0), (1000000002, None)]
    later = spark.createDataFrame([("a", 1, 1000000002, 2, 2, "t", 5)], EXEC7)
    ledger_store.write_ledger(spark, root, {"executions": later})
    final = sorted((r["id_script_execution"], r["rc"]) for r in ledger_store.read_ledger(spark, root)["executions"].collect())
    assert final == [(1000000001, 0), (1000000002, 5)]


def test_tree_with_a_hot_folder(spark, tmp_path):
    """One folder holds nearly all subfolders; every file is found once."""
    from shiplog.sources.tree import tree_inventory

    want = set()
    for i in range(100):
        rel = f"hot/s{i}" if i < 95 else f"cold{i}"
        for name in ("_a.sql", ".b", f"d{i % 3}/c.sql"):
            p = tmp_path / rel / name
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text("")
            want.add(f"{rel}/{name}")
    (tmp_path / ".git" / "x").mkdir(parents=True)
    (tmp_path / ".git" / "x" / "no.sql").write_text("")
    (tmp_path / "top.txt").write_text("")
    (tmp_path / "link").symlink_to(tmp_path / "hot")
    got = [r["path"] for r in tree_inventory(spark, str(tmp_path), parallelism=4).collect()]
    assert len(got) == len(set(got)) and set(got) == want | {"top.txt"}


def test_tree_made_by_tasks_and_listed_by_uri(spark, tmp_path, monkeypatch):
    """The listing of another store's kind finds what the mounted one finds."""
    from shiplog.sources import tree

    paths = [f"d{i % 7}/s{i % 3}/_{i};t.sql" for i in range(200)] + [".git/x.sql", "top;1.sql", "a b/é%20.sql"]
    df = spark.createDataFrame([(p,) for p in paths * 2], "path string")
    root = f"file://{tmp_path}/tree"
    assert tree.make_tree(df, root) == 2 * len(paths)
    want = sorted(set(paths) - {".git/x.sql"})
    assert sorted(r["path"] for r in tree.tree_inventory(spark, root).collect()) == want
    monkeypatch.setattr(tree, "mounted_path", lambda _: None)
    assert sorted(r["path"] for r in tree.tree_inventory(spark, root).collect()) == want


def test_tree_folders_are_made_once_a_task(spark, tmp_path, monkeypatch):
    import os

    import pandas as pd

    from shiplog.sources import tree

    made = []
    monkeypatch.setattr(tree.os, "makedirs", lambda path, exist_ok: (made.append(path), os.mkdir(path)))
    batch = pd.DataFrame({"path": [f"a/{i}" for i in range(50)] + ["b/x", "a/y", "b/x"]})
    assert [out["n"][0] for out in tree._maker(str(tmp_path))(iter([batch, batch]))] == [53, 53]
    assert len(made) == 2 and len(os.listdir(tmp_path / "a")) == 51


def test_events_are_dealt_over_the_tasks(spark, tmp_path):
    """A table of one row group is parsed by all tasks."""
    from shiplog.plans import derived

    rows = spark.range(400).selectExpr("id event_id", "timestamp_ntz '2024-01-02 03:04:05' + make_dt_interval(0, 0, 0, id) ts", "id % 7 user_id", "'click' event_type")
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    dealt = derived.spread_events(spark, str(tmp_path))
    sizes = dealt.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 400 and sum(n > 0 for n in sizes) >= min(4, spark.sparkContext.defaultParallelism)
