"""Deployment ledger as tables: merge, pending list, runs, outcomes, halting,
real/fake classification and sync (J1-J3, J5, J6, W2, W3, P19, P20, L1-L6).

Ledger tables (every key starts with the tenant ``app_id``):

* ``scripts(app_id, id_script, folder, file, package_ts, package_comment,
  script_no, target_id, is_finished)``
* ``runs(app_id, id_run, action, run_ts, env)``
* ``executions(app_id, id_run, id_script_execution, id_script, num_order,
  target_id, rc)`` - ``rc`` null while a script has not reported back.

Scale notes: tenant and run keys are few and hot (one run may hold a third of
all rows), so nothing here partitions a window or a shuffle by them.
Ordering uses the skew-safe ``number_within``; per-tenant and per-run facts
(next run id, last script id, first failure, run settings) are hash
aggregates with map-side combine, stored once and joined plainly, so Spark
chooses between broadcast and shuffle by their size in bytes.
Script-level joins are on unique keys (no skew) and shuffle evenly.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.functions.predicates import DEFAULT_TECH, default_if_blank, in_csv_list
from shiplog.operators.numbering import number_within, stored
from shiplog.session import freeze

# id_script_execution = id_run * scale + num_order; a run would need 2**40
# scripts to reach the next run's ids, and ids stay below 2**63 for 2**22 runs
RUN_ID_SCALE = 1 << 40

# Configuration keys read by the run loop.
NO_RUN_KEY = "cfg_target_no_run"
TECH_KEY_PATTERN = r"(?i)^dpltgt_(.+)_tech\z"

# Execution states.
OPEN, RUNNING, OK, FAILED, NOT_REACHED = "open", "running", "ok", "failed", "not_reached"

SCRIPT_COLUMNS = [
    "app_id",
    "id_script",
    "folder",
    "file",
    "package_ts",
    "package_comment",
    "script_no",
    "target_id",
    "is_finished",
]


SCRIPT_KEY = ["app_id", "folder", "file"]


def script_path(folder: str = "folder", file: str = "file") -> Column:
    return F.concat_ws("/", F.nullif(F.col(folder), F.lit("")), F.col(file))


EXECUTION_ORDER = ["package_ts", "script_no", "path"]


# ---------------------------------------------------------------- J2 / L1


def merge_increments(scripts: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add unknown scripts of unfinished increments to the ledger.

    ``inventory`` = parsed valid scripts with ``app_id``. Known scripts (same
    tenant, folder and file) are kept as they are; scripts inside a finished
    increment are never added. New ids continue after the tenant's highest id
    in execution order. Returns ``(merged ledger, new rows)``; merging the
    same inventory twice adds nothing the second time.
    """
    last_id = scripts.groupBy("app_id").agg(F.max("id_script").alias("_last_id"))
    new_rows = new_scripts(candidate_scripts(inventory), scripts, scripts, last_id)
    merged = scripts.select(*SCRIPT_COLUMNS).unionByName(new_rows)
    return merged, new_rows


def candidate_scripts(inventory: DataFrame) -> DataFrame:
    """Each script of the inventory once (several listings may be combined)."""
    columns = ["app_id", "folder", "file", "package_ts", "package_comment", "script_no", "target_id"]
    return inventory.select(*columns).dropDuplicates(SCRIPT_KEY)


def new_scripts(candidates: DataFrame, known: DataFrame, flagged: DataFrame, last_id: DataFrame) -> DataFrame:
    """The candidates that the ledger does not know, as rows with new ids.

    ``known`` holds every known script that is a candidate, ``flagged`` every
    finished script in a folder of a candidate (both may hold others),
    ``last_id(app_id, _last_id)`` each tenant's highest id."""
    # the de-duplication of the candidates shuffles on the join keys, so the
    # anti join reuses it
    unknown = candidates.join(known.select(*SCRIPT_KEY), SCRIPT_KEY, "left_anti")
    # one row per finished package folder (a folder can be hot)
    finished = stored(flagged.where(F.col("is_finished")).select("app_id", "folder").distinct())
    fresh = unknown.join(finished, ["app_id", "folder"], "left_anti")
    numbered = number_within(fresh.withColumn("path", script_path()), ["app_id"], EXECUTION_ORDER, "_new_no")
    # one row per tenant (tenant keys are hot)
    return numbered.join(stored(last_id), "app_id", "left").select(
        "app_id",
        (F.coalesce(F.col("_last_id"), F.lit(0)) + F.col("_new_no")).alias("id_script"),
        "folder",
        "file",
        "package_ts",
        "package_comment",
        "script_no",
        "target_id",
        F.lit(False).alias("is_finished"),
    )


# ---------------------------------------------------------------- J3 / W3 / L2 / L3


def successful(executions: DataFrame) -> DataFrame:
    """Executions that count as done: return code 0 (real or fake)."""
    return executions.where(F.col("rc") == 0)


def pending(scripts: DataFrame, executions: DataFrame) -> DataFrame:
    """Scripts with no successful execution (anti join on unique keys)."""
    done = successful(executions).select("app_id", "id_script")
    return scripts.join(done, ["app_id", "id_script"], "left_anti")


def last_run_ids(runs: DataFrame) -> DataFrame:
    """``(app_id, _last_run)``: the highest run id per tenant."""
    return runs.groupBy("app_id").agg(F.max("id_run").alias("_last_run"))


def pending_in_order(scripts: DataFrame, executions: DataFrame, runs: DataFrame) -> DataFrame:
    """J3 + W3: the pending scripts numbered for the next run of each tenant.

    Order: package time, script number, then path (unique) for ties.
    """
    todo = pending(scripts, executions).withColumn("path", script_path())
    with_run = todo.join(stored(last_run_ids(runs)), "app_id", "left").withColumn(
        "id_run", (F.coalesce(F.col("_last_run"), F.lit(0)) + 1).cast("bigint")
    ).drop("_last_run")
    return number_within(with_run, ["app_id", "id_run"], EXECUTION_ORDER, "num_order").drop("path")


def increments(scripts: DataFrame) -> DataFrame:
    """One row per increment (package folder); its id is the smallest script
    id inside it, which is stable and unique without a global sequence."""
    return scripts.groupBy("app_id", "folder").agg(F.min("id_script").alias("id_increment"))


def create_run(
    scripts: DataFrame,
    executions: DataFrame,
    runs: DataFrame,
    action: str,
    run_ts: _dt.datetime | None = None,
    env: str | None = None,
) -> dict[str, DataFrame]:
    """L2: one new run per tenant with pending work and one open execution
    per pending script (``rc`` null). ``id_script_execution`` is derived from
    the run id and order number, so re-running the job gives the same ids."""
    ordered = pending_in_order(scripts, executions, runs)
    new_execs = ordered.select(
        "app_id",
        "id_run",
        (F.col("id_run") * RUN_ID_SCALE + F.col("num_order")).alias("id_script_execution"),
        "id_script",
        "num_order",
        "target_id",
        F.lit(None).cast("bigint").alias("rc"),
    )
    stamp = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.localtimestamp()
    new_runs = new_execs.groupBy("app_id", "id_run").agg(F.count(F.lit(1)).alias("n_scripts")).select(
        "app_id",
        "id_run",
        F.lit(action).alias("action"),
        stamp.alias("run_ts"),
        F.lit(env).cast("string").alias("env"),
    )
    return {"runs": new_runs, "executions": new_execs, "ordered": ordered}


def execution_list(executions: DataFrame, scripts: DataFrame, id_run: int | None = None) -> DataFrame:
    """L3: the 8 execution-list columns (plus tenant and run); ``num_order``
    is the run order. ``id_run`` limits the list to one run."""
    if id_run is not None:
        executions = executions.where(F.col("id_run") == id_run)
    inc = stored(increments(scripts))  # one row per package folder
    s = scripts.select("app_id", "id_script", "folder", "file")
    return (
        executions.join(s, ["app_id", "id_script"], "left")
        .join(inc, ["app_id", "folder"], "left")
        .select(
            "app_id",
            "id_run",
            "id_script_execution",
            "num_order",
            "id_script",
            "id_increment",
            "target_id",
            F.col("folder").alias("script_folder"),
            F.col("file").alias("script_file"),
            F.lit(None).cast("string").alias("add_info"),
        )
    )


# ---------------------------------------------------------------- J6 / W2 / L4


def status_of(rc: Column) -> Column:
    return F.when(rc.isNull(), F.lit(OPEN)).when(rc == 0, F.lit(OK)).otherwise(F.lit(FAILED))


def mark_started(executions: DataFrame, started: DataFrame) -> DataFrame:
    """L4 pre phase: ``started(app_id, id_script_execution, started_at)``
    stamps executions a runner has picked up; ``status_started`` reports
    them as running until a return code arrives. Of several stamps of one
    execution (a retry) the last counts."""
    s = started.groupBy("app_id", "id_script_execution").agg(F.max("started_at").alias("_started_new"))
    cols = executions.columns
    base = executions if "started_at" in cols else executions.withColumn("started_at", F.lit(None).cast("timestamp_ntz"))
    return (
        base.join(s, ["app_id", "id_script_execution"], "left")
        .withColumn("started_at", F.coalesce(F.col("_started_new"), F.col("started_at")))
        .drop("_started_new")
    )


def status_started(executions: DataFrame) -> DataFrame:
    """Status including the running state: started, no return code yet."""
    st = status_of(F.col("rc"))
    return executions.withColumn(
        "status", F.when(F.col("rc").isNull() & F.col("started_at").isNotNull(), F.lit(RUNNING)).otherwise(st)
    )


def one_report(returns: DataFrame) -> DataFrame:
    """One row per execution of ``returns(app_id, id_script_execution, rc)``, as
    a runner may report twice. With a column ``reported_at`` the last report
    counts (one without a time before any other); of reports of the same time,
    or without that column, the highest code counts, so a failure beats a
    success. Reports without a code are none."""
    given = returns.where(F.col("rc").isNotNull())
    last = F.max_by("rc", F.struct("reported_at", "rc")) if "reported_at" in returns.columns else F.max("rc")
    return given.groupBy("app_id", "id_script_execution").agg(last.alias("rc"))


def apply_outcomes(executions: DataFrame, returns: DataFrame) -> DataFrame:
    """Store reported return codes (:func:`one_report` of each execution);
    executions without a report keep their current code."""
    r = one_report(returns).withColumnRenamed("rc", "_rc_new")
    return (
        executions.join(r, ["app_id", "id_script_execution"], "left")
        .withColumn("rc", F.coalesce(F.col("_rc_new"), F.col("rc")))
        .drop("_rc_new")
    )


def halt_status(executions: DataFrame) -> DataFrame:
    """Once a script of a run fails, later scripts of that run are not
    reached. Computed as ``num_order > first failing num_order`` of the run,
    i.e. a grouped minimum and a join, not a window over the whole run.

    The input is written once to the shared checkpoint folder and read back
    (it is computed once for both uses; the lineage is cut). The first-failure table has one row per run
    with a failure; it is stored, so Spark broadcasts it when it is small and
    the rows are not shuffled by (tenant, run) - those keys are few and hot.
    """
    frozen = freeze(executions, "halt")
    first_fail = (
        frozen.where(F.col("rc") > 0)
        .groupBy("app_id", "id_run")
        .agg(F.min("num_order").alias("_first_fail"))
    )
    joined = frozen.join(stored(first_fail), ["app_id", "id_run"], "left")
    halted = F.coalesce(F.col("num_order") > F.col("_first_fail"), F.lit(False))
    return joined.withColumn(
        "status", F.when(halted, F.lit(NOT_REACHED)).otherwise(status_of(F.col("rc")))
    ).drop("_first_fail")


def finished_increments(scripts: DataFrame, executions: DataFrame, changed: DataFrame) -> DataFrame:
    """``(app_id, folder)`` of the unfinished increments that ``changed``
    executions belong to and all of whose scripts have succeeded."""
    ids = changed.where(F.col("rc") == 0).select("app_id", "id_script").distinct()
    folders = stored(
        scripts.where(~F.col("is_finished")).join(ids, ["app_id", "id_script"], "left_semi").select("app_id", "folder").distinct()
    )
    members = scripts.select("app_id", "folder", "id_script").join(folders, ["app_id", "folder"], "left_semi")
    done = successful(executions).select("app_id", "id_script")
    still_open = members.join(done, ["app_id", "id_script"], "left_anti").select("app_id", "folder").distinct()
    return stored(folders.join(still_open, ["app_id", "folder"], "left_anti"))


def finish(scripts: DataFrame, finished: DataFrame) -> DataFrame:
    """``scripts`` with the flag of the finished increments set."""
    marks = finished.select("app_id", "folder", F.lit(True).alias("_now"))
    joined = scripts.join(marks, ["app_id", "folder"], "left")
    return joined.withColumn("is_finished", F.col("is_finished") | F.coalesce(F.col("_now"), F.lit(False))).select(*scripts.columns)


# ---------------------------------------------------------------- J1 / J5 / P19 / P20 / L5


def run_settings(config_effective: DataFrame) -> DataFrame:
    """Per environment: the no-run target list (one row per env)."""
    return (
        config_effective.groupBy("env")
        .agg(F.max(F.when(F.col("key") == NO_RUN_KEY, F.col("value"))).alias("no_run"))
    )


def target_techs(config_effective: DataFrame) -> DataFrame:
    """``(env, target_id, tech)`` from ``dpltgt_<target>_tech`` keys."""
    return config_effective.where(F.col("key").rlike(TECH_KEY_PATTERN)).select(
        "env",
        F.regexp_extract("key", TECH_KEY_PATTERN, 1).alias("target_id"),
        F.trim(F.col("value")).alias("tech"),
    )


def with_tech(executions: DataFrame, config_effective: DataFrame) -> DataFrame:
    """Technology per execution from ``dpltgt_<target>_tech`` of its
    environment (``executions`` carries ``env``); default when unset or empty."""
    techs = stored(target_techs(config_effective))
    return executions.join(techs, ["env", "target_id"], "left").withColumn(
        "tech", default_if_blank(F.col("tech"), DEFAULT_TECH)
    )


def classify(executions: DataFrame, runs: DataFrame, config_effective: DataFrame) -> DataFrame:
    """P20 + J1 + L5: fake when the target is on the environment's no-run
    list or the run is a ``sync``; real executions get their technology
    (default when unset or empty); fake ones are recorded as successful."""
    # run-, environment- and target-level tables: few and hot keys
    run_cols = stored(runs.select("app_id", "id_run", "env", "action"))  # one row per run
    settings = stored(run_settings(config_effective))
    techs = stored(target_techs(config_effective))
    x = (
        executions.join(run_cols, ["app_id", "id_run"], "left")
        .join(settings, "env", "left")
        .join(techs, ["env", "target_id"], "left")
    )
    fake = in_csv_list(F.col("target_id"), F.col("no_run")) | F.coalesce(
        F.col("action") == "sync", F.lit(False)
    )
    return (
        x.withColumn("is_fake", fake)
        .withColumn("tech", F.when(~F.col("is_fake"), default_if_blank(F.col("tech"), DEFAULT_TECH)))
        .withColumn("rc", F.when(F.col("is_fake"), F.lit(0).cast("bigint")).otherwise(F.col("rc")))
        .withColumn("status", status_of(F.col("rc")))
        .drop("no_run")
    )


def split_runnable(executions: DataFrame, no_run: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same split as P19 as set operations, for long target lists.

    ``no_run(env, no_run)`` holds the comma lists; they are exploded to one
    row per target and used in a semi / anti join.
    """
    targets = stored(
        no_run.select("env", F.explode(F.split("no_run", ",")).alias("target_id")).distinct()
    )
    return (
        executions.join(targets, ["env", "target_id"], "left_anti"),
        executions.join(targets, ["env", "target_id"], "left_semi"),
    )


def mark_fake(executions: DataFrame) -> DataFrame:
    """Record executions as successful without running them."""
    return executions.withColumn("rc", F.lit(0).cast("bigint")).withColumn("is_fake", F.lit(True)).withColumn(
        "status", F.lit(OK)
    )


def sync(
    scripts: DataFrame,
    executions: DataFrame,
    runs: DataFrame,
    inventory: DataFrame,
    run_ts: _dt.datetime | None = None,
) -> dict[str, DataFrame]:
    """Store the inventory and mark every pending script as executed.

    Merge (L1), create a ``sync`` run (L2) and record all its executions as
    successful fakes (L5). Afterwards nothing is pending.
    """
    merged, _ = merge_increments(scripts, inventory)
    run = create_run(merged, executions, runs, "sync", run_ts)
    done = mark_fake(run["executions"])
    return {"scripts": merged, "runs": run["runs"], "executions": done}
