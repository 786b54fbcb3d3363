"""End-to-end ledger jobs: what one deployment invocation does to the ledger,
for many tenants at once.

``prepare``  scan -> parse -> merge -> create run -> execution list
             (actions ``all``, ``delta``, ``delta-prep``, ``sync``)
``record``   reported return codes -> outcomes + halt -> next snapshot

Running change scripts against databases is outside Spark's job (see the
README); the execution list is what a runner consumes, and its return codes
come back as a table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.operators import inventory as inv_ops
from shiplog.operators import ledger as led
from shiplog.operators.config import split_app_ids
from shiplog.operators.numbering import stored
from shiplog.sources import ledger_store

ACTIONS = ("all", "delta", "delta-prep", "sync")
CONFIG_DDL = "env string, key string, value string"


def prepare(
    spark: SparkSession,
    ledger: dict[str, DataFrame],
    inventory: DataFrame,
    action: str = "all",
    run_ts: dt.datetime | None = None,
    env: str | None = None,
    config: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Merge the inventory and open a run of environment ``env``.

    ``inventory`` = ``DF(app_id, path)``; ``config`` = the effective
    configuration ``DF(env, key, value)``. Rows of an invalid tenant id are
    refused. Executions on targets that the environment does not run, and all
    of a ``sync``, are stored as successful without being run; the others form
    the execution list, with their technology.

    Returns the new ledger tables, the rows to append (``changes``), the
    execution list and the rejected rows (``rejects``: paths,
    ``rejected_tenants``).
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; expected one of {ACTIONS}")
    known, unknown = split_app_ids(inventory)
    parsed = inv_ops.parse_inventory(inv_ops.filter_inventory(known))
    good, bad = inv_ops.split_valid(parsed)
    merged, new_scripts = led.merge_increments(ledger["scripts"], good)
    run = led.create_run(merged, ledger["executions"], ledger["runs"], action, run_ts, env)
    opened = run["executions"]
    settings = config if config is not None else spark.createDataFrame([], CONFIG_DDL)
    sorted_out = stored(led.classify(opened, run["runs"], settings))
    new_execs = sorted_out.select(*opened.columns)
    todo = sorted_out.where(~F.col("is_fake"))
    listing = led.execution_list(todo.select(*opened.columns), merged)
    tables = {
        "scripts": merged,
        "runs": ledger["runs"].unionByName(run["runs"]),
        "executions": ledger["executions"].unionByName(new_execs, allowMissingColumns=True),
    }
    changes = {"scripts": new_scripts, "runs": run["runs"], "executions": new_execs}
    return {
        **tables,
        "changes": changes,
        "execution_list": listing,
        "techs": todo.select("app_id", "id_script_execution", "tech"),
        "rejects": bad,
        "rejected_tenants": unknown,
    }


def record(ledger: dict[str, DataFrame], returns: DataFrame) -> dict[str, DataFrame]:
    """Store return codes ``DF(app_id, id_script_execution, rc)``, which may
    repeat (``led.one_report``).

    Only the runs that reported are touched: executions after a failure in the
    same run stay open and are reported as ``not_reached``. An increment all of
    whose scripts have now succeeded is finished.
    """
    key = ["app_id", "id_script_execution"]
    reported = stored(led.one_report(returns))
    hit = stored(ledger["executions"].join(reported.select(*key), key, "left_semi").select("app_id", "id_run").distinct())
    touched = ledger["executions"].join(hit, ["app_id", "id_run"], "left_semi")
    status = led.halt_status(led.apply_outcomes(touched, reported))
    settled = status.withColumn(
        "rc", F.when(F.col("status") == led.NOT_REACHED, F.lit(None).cast("bigint")).otherwise(F.col("rc"))
    ).drop("status")
    changed = stored(settled.join(reported.select(*key), key, "left_semi"))
    executions = ledger["executions"].join(hit, ["app_id", "id_run"], "left_anti").unionByName(settled)
    finished = led.finished_increments(ledger["scripts"], executions, changed)
    scripts = led.finish(ledger["scripts"], finished)
    return {
        "scripts": scripts,
        "runs": ledger["runs"],
        "executions": executions,
        "status": status,
        "finished": finished,
        "changes": {"executions": changed, "scripts": scripts.join(finished, ["app_id", "folder"], "left_semi")},
    }


def start(ledger: dict[str, DataFrame], started: DataFrame) -> dict[str, DataFrame]:
    """L4 pre phase: stamp executions a runner has picked up
    (``DF(app_id, id_script_execution, started_at)``)."""
    marked = led.mark_started(ledger["executions"], started)
    changed = marked.join(started.select("app_id", "id_script_execution"), ["app_id", "id_script_execution"], "left_semi")
    return {**ledger, "executions": marked, "changes": {"executions": changed}}


def commit(spark: SparkSession, root: str, result: dict, read_version: int | None = None) -> int:
    """Append the changes of a ``prepare`` / ``record`` / ``merge_only``
    result to the ledger as its next version. ``read_version`` is the version
    the result is based on; if another writer has changed the same tenants
    since, ``ledger_store.Conflict`` is raised."""
    return ledger_store.write_ledger(spark, root, result["changes"], read_version=read_version)


def merge_only(ledger: dict[str, DataFrame], inventory: DataFrame) -> dict[str, DataFrame]:
    """L1 alone: store newly found scripts; runs and executions unchanged.
    Idempotent: merging the same inventory again adds nothing."""
    known, unknown = split_app_ids(inventory)
    good, bad = inv_ops.split_valid(inv_ops.parse_inventory(inv_ops.filter_inventory(known)))
    merged, new_rows = led.merge_increments(ledger["scripts"], good)
    return {
        "scripts": merged,
        "runs": ledger["runs"],
        "executions": ledger["executions"],
        "new_scripts": new_rows,
        "rejects": bad,
        "rejected_tenants": unknown,
        "changes": {"scripts": new_rows},
    }
