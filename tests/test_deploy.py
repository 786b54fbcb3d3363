import datetime as dt

from pyspark.sql import functions as F

from shiplog.plans import deploy
from shiplog.session import scratch_path
from shiplog.sources import ledger_store
from shiplog.sources.tree import tree_inventory


def _tree(root, names):
    for rel in names:
        p = root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("-- change\n")


def test_deploy_cycle(spark, tmp_path):
    src = tmp_path / "src"
    _tree(
        src,
        [
            "db/20240101-1000;init/001;core.sql",
            "db/20240101-1000;init/002;core.pck",
            "db/20240102-0900/001;app.sql",
            "db/20240102-0900/002;app.sql",
            "db/20240102-0900/x.sql.tmp",
            ".git/20240101-1000/1;core.sql",
        ],
    )
    inv = tree_inventory(spark, str(src)).withColumn("app_id", F.lit("shop"))
    root = scratch_path(spark, "ledger-test")
    ledger = ledger_store.empty_ledger(spark)

    out = deploy.prepare(spark, ledger, inv, "all", dt.datetime(2024, 3, 1))
    listing = out["execution_list"].orderBy("num_order").collect()
    assert [r["script_file"] for r in listing] == ["001;core.sql", "002;core.pck", "001;app.sql", "002;app.sql"]
    assert out["rejects"].count() == 0
    deploy.commit(spark, root, out)

    # the runner picks up the first two scripts (pre phase)
    stored = ledger_store.read_ledger(spark, root)
    picked = [r["id_script_execution"] for r in listing if r["num_order"] <= 2]
    started = spark.createDataFrame(
        [("shop", x, dt.datetime(2024, 3, 1, 10)) for x in picked],
        "app_id string, id_script_execution bigint, started_at timestamp_ntz",
    )
    deploy.commit(spark, root, deploy.start(stored, started))
    stored = ledger_store.read_ledger(spark, root)
    assert stored["executions"].where("started_at IS NOT NULL").count() == 2

    # the second script fails: the rest of the run is not reached
    second = [r for r in listing if r["num_order"] == 2][0]["id_script_execution"]
    first = [r for r in listing if r["num_order"] == 1][0]["id_script_execution"]
    returns = spark.createDataFrame(
        [("shop", first, 0), ("shop", second, 3)], "app_id string, id_script_execution bigint, rc bigint"
    )
    rec = deploy.record(stored, returns)
    status = {r["num_order"]: r["status"] for r in rec["status"].collect()}
    assert status == {1: "ok", 2: "failed", 3: "not_reached", 4: "not_reached"}
    v3 = deploy.commit(spark, root, rec)
    assert v3 == 3
    after = {r["id_script_execution"]: (r["rc"], r["started_at"]) for r in ledger_store.read_ledger(spark, root)["executions"].collect()}
    assert after[first] == (0, dt.datetime(2024, 3, 1, 10))

    # the next run lists the failed script and everything after it
    again = deploy.prepare(spark, ledger_store.read_ledger(spark, root), inv, "all", dt.datetime(2024, 3, 2))
    nxt = again["execution_list"].orderBy("num_order").collect()
    assert [r["script_file"] for r in nxt] == ["002;core.pck", "001;app.sql", "002;app.sql"]
    assert {r["id_run"] for r in nxt} == {2}

    # sync marks everything as done
    synced = deploy.prepare(spark, ledger_store.read_ledger(spark, root), inv, "sync", dt.datetime(2024, 3, 3))
    from shiplog.operators.ledger import pending

    assert pending(synced["scripts"], synced["executions"]).count() == 0


RETURNS = "app_id string, id_script_execution bigint, rc bigint"


def _inventory(spark, paths, app_id="shop"):
    return spark.createDataFrame([(app_id, p) for p in paths], "app_id string, path string")


def test_environment_targets_and_tenants(spark):
    config = spark.createDataFrame(
        [("dev", "cfg_target_no_run", "app,x"), ("dev", "dpltgt_core_tech", "spark-sql")], "env string, key string, value string"
    )
    inv = _inventory(spark, ["db/20240101-1000/001;core.sql", "db/20240101-1000/002;app.sql", "db/20240101-1000/003;web.sql"])
    wrong = _inventory(spark, ["db/20240101-1000/001;core.sql"], "9 bad!")
    out = deploy.prepare(spark, ledger_store.empty_ledger(spark), inv.union(wrong), "all", dt.datetime(2024, 3, 1), "dev", config)
    assert {r["env"] for r in out["changes"]["runs"].collect()} == {"dev"}
    assert {r["app_id"] for r in out["scripts"].collect()} == {"shop"}
    assert [r["app_id"] for r in out["rejected_tenants"].collect()] == ["9 bad!"]
    assert {r["target_id"]: r["rc"] for r in out["changes"]["executions"].collect()} == {"core": None, "app": 0, "web": None}
    assert sorted(r["target_id"] for r in out["execution_list"].collect()) == ["core", "web"]
    assert sorted(r["tech"] for r in out["techs"].collect()) == ["oracle-sqlplus", "spark-sql"]


def test_a_finished_increment_takes_no_late_script(spark):
    root = scratch_path(spark, "ledger-finish")
    first = ["db/20240101-1000/001;core.sql", "db/20240101-1000/002;core.sql"]
    other = ["db/20240102-1000/001;core.sql"]
    out = deploy.prepare(spark, ledger_store.empty_ledger(spark), _inventory(spark, first + other), "all", dt.datetime(2024, 3, 1))
    deploy.commit(spark, root, out)
    ids = {r["num_order"]: r["id_script_execution"] for r in out["execution_list"].collect()}

    def report(*orders):
        rows = spark.createDataFrame([("shop", ids[n], 0) for n in orders], RETURNS)
        rec = deploy.record(ledger_store.read_ledger(spark, root), rows)
        deploy.commit(spark, root, rec)
        return sorted(r["folder"] for r in ledger_store.read_ledger(spark, root)["scripts"].where("is_finished").collect())

    assert report(1) == []
    assert report(2) == ["db/20240101-1000"] * 2
    late = _inventory(spark, ["db/20240101-1000/003;core.sql", "db/20240102-1000/002;core.sql"])
    again = deploy.merge_only(ledger_store.read_ledger(spark, root), late)
    assert [r["folder"] for r in again["new_scripts"].collect()] == ["db/20240102-1000"]


def test_recording_leaves_other_runs_alone(spark):
    execs = spark.createDataFrame(
        [("a", 1, 11, 1, 1, "t", 5, None), ("a", 1, 12, 2, 2, "t", None, None), ("a", 2, 21, 1, 1, "t", None, None), ("a", 2, 22, 2, 2, "t", None, None)],
        ledger_store.EXECUTIONS_DDL,
    )
    ledger = {**ledger_store.empty_ledger(spark), "executions": execs}
    out = deploy.record(ledger, spark.createDataFrame([("a", 21, 0)], RETURNS))
    assert {r["id_run"] for r in out["status"].collect()} == {2}
    assert {r["id_script_execution"]: r["rc"] for r in out["executions"].collect()} == {11: 5, 12: None, 21: 0, 22: None}


def test_compaction_is_atomic(spark):
    root = scratch_path(spark, "ledger-compact")
    out = deploy.prepare(spark, ledger_store.empty_ledger(spark), _inventory(spark, ["db/20240101-1000/001;core.sql"]), "all", dt.datetime(2024, 3, 1))
    deploy.commit(spark, root, out)

    def counts():
        return {t: df.count() for t, df in ledger_store.read_ledger(spark, root).items()}

    want = {"scripts": 1, "runs": 1, "executions": 1}
    assert counts() == want
    # a crash after the base marker, before the commit marker
    v = ledger_store.compact(spark, root)
    fs, _, jvm = ledger_store._fs(spark, root)
    marker = jvm.org.apache.hadoop.fs.Path(f"{root}/{ledger_store.COMMITTED}/v={v}")
    fs.delete(marker, False)
    assert counts() == want
    fs.create(marker).close()
    assert counts() == want
    ledger_store.compact(spark, root)
    assert counts() == want
