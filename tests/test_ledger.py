import datetime as dt

from pyspark.sql import functions as F

from shiplog.operators import ledger as led
from shiplog.sources.ledger_store import empty_ledger


def _execs(spark, rcs, run=1, app="a"):
    data = [(app, run, run * led.RUN_ID_SCALE + i + 1, 100 + i, i + 1, "t", rc) for i, rc in enumerate(rcs)]
    return spark.createDataFrame(
        data,
        "app_id string, id_run bigint, id_script_execution bigint, id_script bigint, num_order bigint, "
        "target_id string, rc bigint",
    )


def _status(spark, rcs):
    out = led.halt_status(_execs(spark, rcs)).orderBy("num_order").collect()
    return [r["status"] for r in out]


def test_halt_cases(spark):
    assert _status(spark, [1, 0, 0]) == ["failed", "not_reached", "not_reached"]
    assert _status(spark, [0, 2, 0]) == ["ok", "failed", "not_reached"]
    assert _status(spark, [0, 0, 3]) == ["ok", "ok", "failed"]
    assert _status(spark, [0, 1, 1, 0]) == ["ok", "failed", "not_reached", "not_reached"]
    assert _status(spark, [0, 0, 0]) == ["ok", "ok", "ok"]
    assert _status(spark, [0, None, 0]) == ["ok", "open", "ok"]


def test_apply_outcomes_keeps_unreported(spark):
    e = _execs(spark, [None, None, 5])
    ret = spark.createDataFrame([("a", led.RUN_ID_SCALE + 1, 0)], "app_id string, id_script_execution bigint, rc bigint")
    out = {r["num_order"]: r["rc"] for r in led.apply_outcomes(e, ret).collect()}
    assert out == {1: 0, 2: None, 3: 5}


def _inventory(spark):
    rows = [
        ("a", "p/20240101-1000/1;t1.sql", dt.datetime(2024, 1, 1, 10), 1),
        ("a", "p/20240101-1000/2;t2.sql", dt.datetime(2024, 1, 1, 10), 2),
        ("a", "p/20240102-0900;x/1;t1.sql", dt.datetime(2024, 1, 2, 9), 1),
        ("b", "p/20240101-1000/1;t1.sql", dt.datetime(2024, 1, 1, 10), 1),
    ]
    df = spark.createDataFrame(rows, "app_id string, path string, package_ts timestamp_ntz, script_no bigint")
    return df.select(
        "app_id",
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("file"),
        "package_ts",
        F.lit(None).cast("string").alias("package_comment"),
        "script_no",
        F.regexp_extract("path", r";([A-Za-z0-9_]+)\.", 1).alias("target_id"),
    )


def test_merge_twice_is_merge_once_and_sync_empties_pending(spark):
    lg = empty_ledger(spark)
    inv = _inventory(spark)
    once, new1 = led.merge_increments(lg["scripts"], inv)
    assert new1.count() == 4
    twice, new2 = led.merge_increments(once, inv)
    assert new2.count() == 0 and twice.count() == 4
    # ids continue per tenant in execution order
    ids = {(r["app_id"], r["file"], r["folder"]): r["id_script"] for r in once.collect()}
    assert ids[("a", "1;t1.sql", "p/20240101-1000")] == 1
    assert ids[("a", "1;t1.sql", "p/20240102-0900;x")] == 3
    assert ids[("b", "1;t1.sql", "p/20240101-1000")] == 1
    synced = led.sync(lg["scripts"], lg["executions"], lg["runs"], inv, dt.datetime(2024, 2, 1))
    assert synced["executions"].where("status = 'ok' AND is_fake").count() == 4
    execs = synced["executions"].drop("is_fake", "status")
    assert led.pending(synced["scripts"], execs).count() == 0


def test_finished_increment_is_not_touched(spark):
    lg = empty_ledger(spark)
    inv = _inventory(spark)
    merged, _ = led.merge_increments(lg["scripts"], inv.where("file = '1;t1.sql'"))
    finished = merged.withColumn("is_finished", F.lit(True))
    _, new_rows = led.merge_increments(finished, inv)
    # 2;t2.sql sits in a finished increment of tenant a: not added
    assert new_rows.count() == 0


def test_pending_order_and_run_ids(spark):
    lg = empty_ledger(spark)
    merged, _ = led.merge_increments(lg["scripts"], _inventory(spark))
    run = led.create_run(merged, lg["executions"], lg["runs"], "all", dt.datetime(2024, 2, 1))
    got = sorted((r["app_id"], r["num_order"], r["id_script"], r["id_script_execution"]) for r in run["executions"].collect())
    assert got == [
        ("a", 1, 1, led.RUN_ID_SCALE + 1),
        ("a", 2, 2, led.RUN_ID_SCALE + 2),
        ("a", 3, 3, led.RUN_ID_SCALE + 3),
        ("b", 1, 1, led.RUN_ID_SCALE + 1),
    ]
    assert run["runs"].count() == 2


def test_classify_and_split_runnable_agree(spark):
    e = _execs(spark, [None, None, None]).withColumn(
        "target_id", F.element_at(F.array(F.lit("t1"), F.lit("t2"), F.lit("t3")), F.col("num_order").cast("int"))
    )
    runs = spark.createDataFrame([("a", 1, "all", None, "dev")], "app_id string, id_run bigint, action string, run_ts timestamp_ntz, env string")
    cfg = spark.createDataFrame(
        [("dev", "cfg_target_no_run", "t1,t3"), ("dev", "dpltgt_t2_tech", " spark-sql ")],
        "env string, key string, value string",
    )
    out = {r["target_id"]: (r["is_fake"], r["tech"], r["status"]) for r in led.classify(e, runs, cfg).collect()}
    assert out == {"t1": (True, None, "ok"), "t2": (False, "spark-sql", "open"), "t3": (True, None, "ok")}
    with_env = e.withColumn("env", F.lit("dev"))
    runnable, fake = led.split_runnable(with_env, led.run_settings(cfg))
    assert sorted(r["target_id"] for r in runnable.collect()) == ["t2"]
    assert sorted(r["target_id"] for r in fake.collect()) == ["t1", "t3"]
    # default technology when unset or empty
    cfg2 = spark.createDataFrame([("dev", "dpltgt_t2_tech", "")], "env string, key string, value string")
    out2 = {r["target_id"]: r["tech"] for r in led.classify(e, runs, cfg2).collect()}
    assert out2 == {"t1": "oracle-sqlplus", "t2": "oracle-sqlplus", "t3": "oracle-sqlplus"}


def test_pre_phase_marks_running(spark):
    e = _execs(spark, [None, None])
    started = spark.createDataFrame(
        [("a", led.RUN_ID_SCALE + 1, dt.datetime(2024, 1, 1, 12))], "app_id string, id_script_execution bigint, started_at timestamp_ntz"
    )
    marked = led.mark_started(e, started)
    got = {r["num_order"]: r["status"] for r in led.status_started(marked).collect()}
    assert got == {1: "running", 2: "open"}
    ret = spark.createDataFrame([("a", led.RUN_ID_SCALE + 1, 0)], "app_id string, id_script_execution bigint, rc bigint")
    done = led.status_started(led.apply_outcomes(marked, ret))
    assert {r["num_order"]: r["status"] for r in done.collect()} == {1: "ok", 2: "open"}


def test_merge_ignores_repeated_listing(spark):
    lg = empty_ledger(spark)
    inv = _inventory(spark)
    _, new_rows = led.merge_increments(lg["scripts"], inv.unionByName(inv))
    assert new_rows.count() == 4
