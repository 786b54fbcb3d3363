"""Return codes on a live feed: late, repeated and withdrawn reports."""

import datetime as dt

import pytest
from helpers import rows

from shiplog.operators import ledger as led
from shiplog.streaming import outcome_feed as feed


def at(minute):
    return None if minute is None else dt.datetime(2024, 1, 1, 0, minute)


@pytest.fixture
def drop(spark, tmp_path):
    """Send reports (run, execution, code, minute) and let the feed take them."""

    def send(*reports, order=lambda e: e):
        data = [("a", run, e, order(e), rc, at(minute)) for run, e, rc, minute in reports]
        spark.createDataFrame(data, feed.REPORT).write.mode("append").parquet(str(tmp_path / "in"))
        q = feed.start_outcome_feed(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), shards=2, available_now=True)
        q.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    return send


def test_first_failure_moves_both_ways(drop):
    out = drop((1, 10, 0, 1), (1, 11, 1, 1), (1, 12, 1, 1), (2, 20, 0, 1))
    assert rows(feed.first_failures(out)) == [("a", 1, 11)]
    out = drop((1, 11, 0, 2))  # the retry succeeded: 12 is the first failure now
    assert rows(feed.first_failures(out)) == [("a", 1, 12)]
    out = drop((1, 11, 1, 1), (1, 10, 3, None))  # a late copy and a report without a time change nothing
    assert rows(feed.first_failures(out)) == [("a", 1, 12)]
    out = drop((1, 10, 5, 3), (2, 20, 0, 1))
    assert rows(feed.first_failures(out)) == [("a", 1, 10)]
    out = drop((1, 10, 0, 4), (1, 12, 0, 4))  # nothing fails any more: the halt is lifted
    assert rows(feed.first_failures(out)) == []
    assert rows(feed.reported(out)) == [("a", 1, 10, 0), ("a", 1, 11, 0), ("a", 1, 12, 0), ("a", 2, 20, 0)]


def test_reports_of_one_time_and_incomplete_ones(drop):
    out = drop((1, 10, 0, 1), (1, 10, 2, 1), (1, 11, None, 1), (None, 12, 1, 1), (1, 13, 0, None), (1, 13, 1, None))
    assert rows(feed.reported(out)) == [("a", 1, 10, 2), ("a", 1, 13, 1)]
    again = drop((1, 10, 2, 1), (1, 10, 0, 1))
    assert again.count() == out.count()


def test_same_as_the_batch_outcomes(spark, drop):
    import random

    rng = random.Random(4)
    sent = [(rng.randrange(3), e, rng.choice([0, 0, 0, 1, 9]), rng.randrange(5)) for e in range(60) for _ in range(3)]
    run_of = {e: run for run, e, _, _ in sent}
    sent = [(run_of[e], e, rc, minute) for _, e, rc, minute in sent]
    rng.shuffle(sent)
    for start in range(0, len(sent), 60):
        out = drop(*sent[start : start + 60], order=lambda e: (e * 7) % 61)
    execs = spark.createDataFrame(
        [("a", run, e, (e * 7) % 61, None) for e, run in run_of.items()] + [("a", 0, 99, 99, None)],
        "app_id string, id_run bigint, id_script_execution bigint, num_order bigint, rc bigint",
    )
    reports = spark.createDataFrame([("a", e, rc, at(minute)) for _, e, rc, minute in sent], "app_id string, id_script_execution bigint, rc bigint, reported_at timestamp_ntz")
    want = led.halt_status(led.apply_outcomes(execs, reports))
    cols = ["app_id", "id_run", "id_script_execution", "num_order", "rc", "status"]
    assert rows(feed.live_status(execs, out), *cols) == rows(want, *cols)


def test_state_is_read_a_block_at_a_time(monkeypatch):
    """Reports of neighbouring executions take one read and one write of state."""
    import pandas as pd

    calls = []

    class State(dict):
        exists = lambda self: bool(self)
        get = lambda self: self["row"]
        update = lambda self, row: self.__setitem__("row", row)
        containsKey = dict.__contains__

        def getValue(self, key):
            calls.append("read")
            return self[key]

        def updateValue(self, key, value):
            calls.append("write")
            self[key] = value

    shard = feed.LastReports()
    shard.last, shard.shard = State(), State()

    def send(code, minute):
        ids = list(range(1000, 3000))
        given = pd.DataFrame({"id_script_execution": ids, "num_order": ids, "rc": [code] * 2000, "at": [minute] * 2000})
        return sum(len(out) for out in shard.handleInputRows(("a", 1, 0), iter([given[:700], given[700:]]), None))

    assert send(0, 1) == 2000 and send(5, 2) == 2001 and send(0, 1) == 0 and send(0, 3) == 2001
    assert len(calls) <= 2 * 4 * (2000 // feed.BLOCK + 2)
    assert shard.shard["row"] == (3, None)
