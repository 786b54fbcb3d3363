"""Several writers on one ledger, and the change feed."""

import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shiplog.operators import ledger as led
from shiplog.sources import ledger_store as store


def _scripts(spark, app, ids, target="t"):
    return spark.createDataFrame([(app, i, "f", f"{i};t.sql", None, None, i, target, False) for i in ids], store.SCRIPTS_DDL)


def _execs(spark, app, codes):
    return spark.createDataFrame([(app, 1, i, i, i, "t", rc, None) for i, rc in codes.items()], store.EXECUTIONS_DDL)


def test_two_writers_of_one_tenant_conflict(spark, tmp_path):
    root = str(tmp_path / "led")
    store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [1])})
    read = store.latest_version(spark, root)
    # both are based on version 1; the first commits
    assert store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [2])}, read_version=read) == 2
    with pytest.raises(store.Conflict) as e:
        store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [2], "other")}, read_version=read)
    assert (e.value.version, e.value.tenants) == (2, ["a"])
    # nothing of the loser is visible; another tenant does not conflict
    assert store.write_ledger(spark, root, {"scripts": _scripts(spark, "b x/y", [9])}, read_version=read) == 3
    assert rows(store.read_ledger(spark, root)["scripts"], "app_id", "id_script", "target_id") == [("a", 1, "t"), ("a", 2, "t"), ("b x/y", 9, "t")]
    with pytest.raises(store.Conflict):
        store.write_ledger(spark, root, {"scripts": _scripts(spark, "b x/y", [9])}, read_version=2)


def test_a_marker_is_put_once(spark, tmp_path):
    path = str(tmp_path / "_committed" / "v=1")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: store.put_if_absent(spark, path, str(k).encode()), range(40)))
    assert sum(won) == 1
    assert open(path).read() == str(won.index(True)) and os.listdir(tmp_path / "_committed") == ["v=1"]


def test_racing_writers_get_versions_of_their_own(spark, tmp_path):
    """Interleaved commits of several tables never mix versions."""
    root = str(tmp_path / "led")

    def write(k):
        frames = {"scripts": _scripts(spark, f"app{k}", [k]), "executions": _execs(spark, f"app{k}", {k: k})}
        return k, store.write_ledger(spark, root, frames, read_version=0)

    with ThreadPoolExecutor(4) as pool:
        done = dict(pool.map(write, range(6)))
    assert sorted(done.values()) == list(range(1, 7))
    for k, v in done.items():
        now, before = store.read_ledger(spark, root, as_of=v), store.read_ledger(spark, root, as_of=v - 1) if v > 1 else store.empty_ledger(spark)
        for table in ("scripts", "executions"):
            new = {r[0] for r in rows(now[table], "app_id")} - {r[0] for r in rows(before[table], "app_id")}
            assert new == {f"app{k}"}


def test_updates_retry_on_the_newer_state(spark, tmp_path):
    root = str(tmp_path / "led")
    store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [1])})
    tries = []

    def add_one(state):
        top = state["scripts"].agg(F.max("id_script")).first()[0]
        tries.append(top)
        if len(tries) == 1:  # another writer is faster
            store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [top + 1], "first")})
        return {"scripts": _scripts(spark, "a", [top + 1], "second")}

    assert store.update_ledger(spark, root, add_one) == 3
    assert tries == [1, 2]
    assert rows(store.read_ledger(spark, root)["scripts"], "id_script", "target_id") == [(1, "t"), (2, "first"), (3, "second")]
    with pytest.raises(store.Conflict):
        store.update_ledger(spark, root, lambda s: store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [7])}) and {"scripts": _scripts(spark, "a", [8])}, attempts=2)


def test_compaction_yields_to_a_commit_it_has_not_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "led")
    store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [1])})
    write = store.write_ledger

    def slow(*args, **kwargs):
        write(spark, root, {"scripts": _scripts(spark, "b", [2])})
        return write(*args, **kwargs)

    monkeypatch.setattr(store, "write_ledger", slow)
    with pytest.raises(store.Conflict):
        store.compact(spark, root)
    monkeypatch.undo()
    # a compaction is no conflict for a writer that read before it
    assert store.compact(spark, root) == 3
    assert store.write_ledger(spark, root, {"scripts": _scripts(spark, "a", [3])}, read_version=2) == 4
    assert rows(store.read_ledger(spark, root)["scripts"], "app_id", "id_script") == [("a", 1), ("a", 3), ("b", 2)]


def test_ledger_with_numbered_folders_is_read(spark, tmp_path):
    """Versions written before transactions had names: empty markers."""
    root = str(tmp_path / "led")
    for v, rc in ((1, None), (2, 0)):
        _execs(spark, "a", {5: rc}).withColumn("v", F.lit(v)).write.mode("append").partitionBy("v", "app_id").parquet(f"{root}/executions")
        os.makedirs(f"{root}/_committed", exist_ok=True)
        open(f"{root}/_committed/v={v}", "w").close()
    assert rows(store.read_ledger(spark, root)["executions"], "rc") == [(0,)]
    assert store.write_ledger(spark, root, {"executions": _execs(spark, "a", {5: 3})}) == 3
    assert rows(store.read_ledger(spark, root)["executions"], "rc") == [(3,)]
    assert rows(store.changes(spark, root, "executions", 1), "id_script_execution", "rc", "change", "v") == [(5, 3, "update", 3)]


@pytest.mark.parametrize("seed", [1])
def test_feed_leads_from_one_state_to_the_other(spark, tmp_path, seed):
    """State at b = state at a with the feed's rows, for random commits."""
    rng = random.Random(seed)
    root = str(tmp_path / "led")
    for turn in range(5):
        if turn == 3:
            store.compact(spark, root)
            continue
        for app in rng.sample("abc", 2):
            codes = {i: rng.choice([None, 0, 1]) for i in rng.sample(range(8), 3)}
            store.write_ledger(spark, root, {"executions": _execs(spark, app, codes)})
    last = store.latest_version(spark, root)
    state = {v: {r[:2]: r[2] for r in rows(store.read_ledger(spark, root, as_of=v)["executions"], "app_id", "id_script_execution", "rc")} for v in range(1, last + 1)}
    for a, b in ((1, last), (2, 4), (4, last), (last, last)):
        feed = {(r["app_id"], r["id_script_execution"]): r for r in store.changes(spark, root, "executions", a, b).collect()}
        assert {**state[a], **{k: r["rc"] for k, r in feed.items()}} == state[b]
        assert all((r["change"] == "update") == (k in state[a]) for k, r in feed.items())
        assert all(r["old"]["rc"] == state[a][k] for k, r in feed.items() if r["change"] == "update")
        assert all(a < r["v"] <= b for r in feed.values())


def test_runs_are_fed_too(spark, tmp_path):
    root = str(tmp_path / "led")
    runs = lambda i: spark.createDataFrame([("a", i, "all", None, "dev")], store.RUNS_DDL)
    store.write_ledger(spark, root, {"runs": runs(1)})
    store.write_ledger(spark, root, {"runs": runs(2)})
    assert rows(store.changes(spark, root, "runs", 0), "id_run", "change", "v") == [(1, "insert", 1), (2, "insert", 2)]
    assert rows(store.changes(spark, root, "runs", 1), "id_run") == [(2,)]


def test_repeated_reports(spark):
    """One row per execution whatever is reported how often."""
    execs = _execs(spark, "a", {1: None, 2: None, 3: None, 4: 7})
    returns = spark.createDataFrame([("a", 1, 0), ("a", 1, 0), ("a", 2, 1), ("a", 2, 0), ("a", 3, None)], "app_id string, id_script_execution long, rc long")
    assert rows(led.apply_outcomes(execs, returns), "id_script_execution", "rc") == [(1, 0), (2, 1), (3, None), (4, 7)]
    stamps = spark.createDataFrame(
        [("a", 1, 3, "2024-01-02"), ("a", 1, 0, "2024-01-03"), ("a", 2, 0, "2024-01-02"), ("a", 2, 5, "2024-01-02"), ("a", 3, 0, "2024-01-01"), ("a", 3, 9, None)],
        "app_id string, id_script_execution long, rc long, reported_at string",
    )
    assert rows(led.apply_outcomes(execs, stamps), "id_script_execution", "rc") == [(1, 0), (2, 5), (3, 0), (4, 7)]
    started = spark.createDataFrame([("a", 1, "2024-01-01"), ("a", 1, "2024-01-05")], "app_id string, id_script_execution long, s string")
    marked = led.mark_started(execs, started.select("app_id", "id_script_execution", F.col("s").cast("timestamp_ntz").alias("started_at")))
    assert marked.count() == 4 and str(marked.where("id_script_execution = 1").first()["started_at"]) == "2024-01-05 00:00:00"


def test_a_version_is_not_read_into_one_task(spark, tmp_path):
    """Rows are not dealt by transaction: a version's rows stay spread."""
    root = str(tmp_path / "led")
    store.write_ledger(spark, root, {"executions": _execs(spark, "a", {i: None for i in range(50)})})
    store.write_ledger(spark, root, {"executions": _execs(spark, "a", {i: 0 for i in range(0, 50, 2)})})
    for df in (store.read_ledger(spark, root)["executions"], store.changed_rows(spark, root, "executions", 0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_txn" not in plan and "hashpartitioning(app_id" in plan
        assert sum(r["rc"] is None for r in df.collect()) == 25
