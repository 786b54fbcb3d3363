"""The maintained pending list against the full computation."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shiplog.operators import ledger as led
from shiplog.plans import pending_view as view
from shiplog.sources import ledger_store as store

COLUMNS = ("app_id", "id_run", "num_order", "id_script", "folder", "file", "target_id", "package_ts", "script_no")


def _script(app, i, day, no):
    return (app, i, f"2024{day:04d}", f"{no};t{i}.sql", dt.datetime(2024, day // 100, day % 100, 10), None, no, "t", False)


def _scripts(spark, given):
    return spark.createDataFrame(given, store.SCRIPTS_DDL)


def _execs(spark, given):
    return spark.createDataFrame([(app, run, run * 1000 + i, i, i, "t", rc, None) for app, run, i, rc in given], store.EXECUTIONS_DDL)


def _full(spark, root):
    lg = store.read_ledger(spark, root)
    return rows(led.pending_in_order(lg["scripts"], lg["executions"], lg["runs"]), *COLUMNS)


def _held(spark, root, at):
    return rows(view.pending_list(spark, at, store.read_ledger(spark, root)["runs"]), *COLUMNS)


@pytest.mark.parametrize("seed", [1])
def test_equal_to_the_full_list_after_any_commits(spark, tmp_path, seed):
    rng = random.Random(seed)
    root, at = str(tmp_path / "led"), str(tmp_path / "view")
    known: list[tuple] = []
    for turn in range(5):
        fresh = [_script(rng.choice("ab"), 10 * turn + k, rng.choice([101, 102, 215]), rng.randint(1, 3)) for k in range(6)]
        codes = [(s[0], turn + 1, s[1], rng.choice([None, 0, 0, 1])) for s in rng.sample(known + fresh, 5)]
        if turn == 3:  # success that is overwritten by a failure
            done = store.read_ledger(spark, root)["executions"].where("rc = 0").limit(1).collect()
            codes += [(r["app_id"], r["id_run"], r["id_script"], 1) for r in done]
        runs = spark.createDataFrame([(a, turn + 1, "all", None, None) for a in "ab"], store.RUNS_DDL)
        store.write_ledger(spark, root, {"scripts": _scripts(spark, fresh), "runs": runs, "executions": _execs(spark, list(dict.fromkeys(codes)))})
        known += fresh
        if turn == 2:
            store.compact(spark, root)
        if turn != 1:  # a refresh may take several commits at once
            assert view.refresh(spark, root, at) == store.latest_version(spark, root)
            assert _held(spark, root, at) == _full(spark, root)
    assert view.refresh(spark, root, at) == view.refreshed(spark, at)


def _files(at):
    found = {}
    for top, _, names in os.walk(os.path.join(at, "rows")):
        for n in names:
            if n.startswith("part-"):
                found[os.path.join(top, n)] = os.path.getmtime(os.path.join(top, n))
    return found


def test_only_touched_ranges_are_read_and_written(spark, tmp_path):
    root, at = str(tmp_path / "led"), str(tmp_path / "view")
    given = [_script("a", 100 * d + k, 101 + d, k + 1) for d in range(8) for k in range(20)] + [_script("b", k, 101, k + 1) for k in range(20)]
    store.write_ledger(spark, root, {"scripts": _scripts(spark, given)})
    view.refresh(spark, root, at)
    before = _files(at)
    store.write_ledger(spark, root, {"executions": _execs(spark, [("a", 1, 302, 0), ("a", 1, 305, 0)])})
    view.refresh(spark, root, at)
    new = set(_files(at)) - set(before)
    assert len(new) == 1 and all("app_id=a/day=20240104" in f for f in new)
    got = view.pending_list(spark, at, spark.createDataFrame([], store.RUNS_DDL))
    assert rows(got.groupBy("app_id", "written").count()) == [("a", 1, 140), ("a", 2, 18), ("b", 1, 20)]
    assert rows(got.groupBy("app_id").agg(F.max("num_order"), F.count_distinct("num_order"))) == [("a", 158, 158), ("b", 20, 20)]
    # files of other ranges can be gone: a refresh does not read them
    for f in before:
        if "day=20240104" not in f and "day=20240108" not in f:
            os.truncate(f, 0)
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.unlink(crc)
    store.write_ledger(spark, root, {"executions": _execs(spark, [("a", 1, 301, 0), ("a", 1, 701, 0)])})
    assert view.refresh(spark, root, at) == 3


def test_a_refresh_that_dies_leaves_the_last_list(spark, tmp_path, monkeypatch):
    root, at = str(tmp_path / "led"), str(tmp_path / "view")
    store.write_ledger(spark, root, {"scripts": _scripts(spark, [_script("a", k, 101, k + 1) for k in range(5)])})
    view.refresh(spark, root, at)
    was = _held(spark, root, at)
    store.write_ledger(spark, root, {"executions": _execs(spark, [("a", 1, 2, 0)])})
    monkeypatch.setattr(store, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        view.refresh(spark, root, at)
    assert _held(spark, root, at) == was
    monkeypatch.undo()
    view.refresh(spark, root, at)
    assert _held(spark, root, at) == _full(spark, root) != was


def test_scripts_without_a_package_time_and_one_tenant(spark, tmp_path):
    root, at = str(tmp_path / "led"), str(tmp_path / "view")
    odd = [("a", 1, "x", "1;t.sql", None, None, 1, "t", False), _script("a", 2, 101, 1), _script("b", 3, 101, 1)]
    store.write_ledger(spark, root, {"scripts": _scripts(spark, odd)})
    view.refresh(spark, root, at)
    assert _held(spark, root, at) == _full(spark, root)
    runs = store.read_ledger(spark, root)["runs"]
    assert rows(view.pending_list(spark, at, runs, app_id="b"), "id_script", "num_order") == [(3, 1)]


def test_no_ledger_and_no_view(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        view.refresh(spark, str(tmp_path / "none"), str(tmp_path / "view"))
    with pytest.raises(FileNotFoundError):
        view.pending_list(spark, str(tmp_path / "view"), spark.createDataFrame([], store.RUNS_DDL))
