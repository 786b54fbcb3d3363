"""W2 + L4 on a live feed: return codes as they arrive, halting on failure.

Runners report return codes one by one, late, twice or corrected by a retry.
The feed keeps the last report of every execution as state and, per shard of a
run, the first failing order number among these reports. It writes what
changed: a row per execution whose code is new, and a row per shard whose first
failure moved. A failure that a later report withdraws moves it back, so the
halt is lifted.

Keys and size: one run may hold a third of all executions, so the state of a run
is split over ``shards`` keys by a hash of the execution's block, ``BLOCK``
neighbouring execution ids. The first failure of a run is the minimum over its
shards, at most ``shards`` rows a run. State is held in RocksDB, an entry per
block, so a batch reads and writes the blocks of its own reports only, each once
(at most ``BLOCK`` reports of 32 bytes); the shard is read through only when its
first failure is withdrawn. The file sink takes each batch once, also after a restart.

Which report counts is as in :func:`shiplog.operators.ledger.one_report`: the
last by ``reported_at`` (none is before any other), of the same time the highest
code. Reports without a code, a run or an execution are none; late ones are not dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shiplog.operators.ledger import NOT_REACHED, status_of
from shiplog.operators.numbering import stored

REPORT = "app_id string, id_run bigint, id_script_execution bigint, num_order bigint, rc bigint, reported_at timestamp_ntz"
CHANGE = "app_id string, id_run bigint, shard int, change bigint, id_script_execution bigint, rc bigint, first_fail bigint"
SHARDS = 64
_BLOCK_BITS = 8
#: Neighbouring execution ids whose reports are one entry of the state.
BLOCK = 1 << _BLOCK_BITS
#: A block's reports, ordered by execution.
_REPORTS = np.dtype([("id", "<i8"), ("at", "<i8"), ("rc", "<i8"), ("order", "<i8")])
NEVER = -(1 << 63)  # reported_at of a report without a time
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _last_reports(rows: pd.DataFrame) -> np.ndarray:
    """The report that counts of every execution, ordered by execution."""
    out = np.empty(len(rows), dtype=_REPORTS)
    for field, column in (("id", "id_script_execution"), ("at", "at"), ("rc", "rc"), ("order", "num_order")):
        out[field] = rows[column].to_numpy()
    out = out[np.lexsort((-out["order"], out["rc"], out["at"], out["id"]))]
    return out[np.append(out["id"][1:] != out["id"][:-1], True)]


class LastReports(StatefulProcessor):
    """State of one shard of a run: the reports that count, a block of
    executions an entry, and (changes written, first failing order number)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "block bigint", "reports binary")
        self.shard = handle.getValueState("shard", "changes bigint, first_fail bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = _last_reports(pd.concat(list(rows)))
        changes, first = self.shard.get() if self.shard.exists() else (0, None)
        before, withdrawn, changed = first, False, []
        edges = np.flatnonzero(np.diff(new["id"] >> _BLOCK_BITS)) + 1
        for given in np.split(new, edges):
            block = (int(given["id"][0] >> _BLOCK_BITS),)
            held = self.last.getValue(block)[0] if self.last.containsKey(block) else b""
            old = np.frombuffer(held, dtype=_REPORTS)
            # what is held of the given executions, where there is any
            had = np.isin(given["id"], old["id"])
            was = np.zeros(len(given), dtype=_REPORTS)
            was[had] = old[np.searchsorted(old["id"], given["id"][had])]
            counts = ~had | (given["at"] > was["at"]) | ((given["at"] == was["at"]) & (given["rc"] > was["rc"]))
            given, was, had = given[counts], was[counts], had[counts]
            if not len(given):
                continue
            now = np.concatenate([old[~np.isin(old["id"], given["id"])], given])
            self.last.updateValue(block, (now[np.argsort(now["id"])].tobytes(),))
            changed.append(given[~had | (was["rc"] != given["rc"])])
            fails = given["rc"] > 0
            if fails.any():
                lowest = int(given["order"][fails].min())
                first = lowest if first is None else min(first, lowest)
            withdrawn |= before is not None and bool((~fails & had & (was["rc"] > 0) & (was["order"] == before)).any())
        if withdrawn:
            first = None
            for (reports,) in self.last.values():
                part = np.frombuffer(reports, dtype=_REPORTS)
                orders = part["order"][part["rc"] > 0]
                if len(orders):
                    first = int(orders.min()) if first is None else min(first, int(orders.min()))
        n_changed = sum(map(len, changed))
        if not n_changed and first == before:
            self.shard.update((changes, first))
            return
        changes += 1
        self.shard.update((changes, first))
        app_id, id_run, shard = key
        moved = np.concatenate([np.empty(0, dtype=_REPORTS), *changed])
        out = pd.DataFrame({"id_script_execution": moved["id"], "rc": moved["rc"]}).astype("Int64")
        out["first_fail"] = pd.array([None] * len(out), dtype="Int64")
        if first != before:
            out.loc[len(out)] = [pd.NA, pd.NA, pd.NA if first is None else first]
        out.insert(0, "app_id", app_id)
        out.insert(1, "id_run", id_run)
        out.insert(2, "shard", shard)
        out.insert(3, "change", changes)
        yield out

    def close(self) -> None:
        pass


def changes_of(reports: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The changes that a stream of reports (``REPORT``) makes."""
    at = F.coalesce(F.unix_micros(F.col("reported_at").cast("timestamp")), F.lit(NEVER))
    keyed = reports.where("rc is not null and id_run is not null and id_script_execution is not null and num_order is not null").select(
        "app_id",
        "id_run",
        F.pmod(F.xxhash64(F.shiftright("id_script_execution", _BLOCK_BITS)), F.lit(shards)).cast("int").alias("shard"),
        "id_script_execution",
        "num_order",
        "rc",
        at.alias("at"),
    )
    return keyed.groupBy("app_id", "id_run", "shard").transformWithStateInPandas(
        statefulProcessor=LastReports(), outputStructType=CHANGE, outputMode="Append", timeMode="None"
    )


def start_outcome_feed(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    checkpoint_location: str,
    shards: int = SHARDS,
    available_now: bool = False,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start the feed over report files dropped in ``source_dir``; the changes
    go to ``out_dir``. ``shards`` is fixed with the checkpoint."""
    reports = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    writer = (
        changes_of(reports, shards)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    given = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)  # read once, when the query starts
    try:
        return writer.start()
    finally:
        if given is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, given)


def reported(changes: DataFrame) -> DataFrame:
    """(app_id, id_run, id_script_execution, rc): the codes that count now."""
    return (
        changes.where(F.col("id_script_execution").isNotNull())
        .groupBy("app_id", "id_run", "id_script_execution")
        .agg(F.max_by("rc", "change").alias("rc"))
    )


def first_failures(changes: DataFrame) -> DataFrame:
    """(app_id, id_run, first_fail) of the runs that are halted now."""
    shard = (
        changes.where(F.col("id_script_execution").isNull())
        .groupBy("app_id", "id_run", "shard")
        .agg(F.max_by(F.struct("first_fail"), "change").alias("now"))
    )
    return shard.where(F.col("now.first_fail").isNotNull()).groupBy("app_id", "id_run").agg(F.min("now.first_fail").alias("first_fail"))


def live_status(executions: DataFrame, changes: DataFrame) -> DataFrame:
    """Code and status of every execution after the changes so far: an order
    number behind its run's first failure is not reached."""
    codes = reported(changes).select("app_id", "id_run", "id_script_execution", F.col("rc").alias("_rc"))
    joined = executions.join(codes, ["app_id", "id_run", "id_script_execution"], "left").join(
        stored(first_failures(changes)), ["app_id", "id_run"], "left"
    )
    rc = F.coalesce(F.col("_rc"), F.col("rc")) if "rc" in executions.columns else F.col("_rc")
    halted = F.coalesce(F.col("num_order") > F.col("first_fail"), F.lit(False))
    return (
        joined.withColumn("rc", rc)
        .withColumn("status", F.when(halted, F.lit(NOT_REACHED)).otherwise(status_of(F.col("rc"))))
        .drop("_rc", "first_fail")
    )
