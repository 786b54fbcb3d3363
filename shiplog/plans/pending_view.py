"""J3 + W3 kept up to date: the pending list as a maintained view.

The list in execution order is cut into ranges (tenant, package day), which
follow each other in that order. A refresh takes what the ledger's change feed
holds since the last one, finds the ranges that it touches, and writes these
anew; every other range keeps its files. A row stores its rank in its range;
its number in the list is that rank plus the rows of the ranges before, which
come from a table of one row per range. So a refresh reads rows in proportion
to the change, however long the ledger and the list are::

    <root>/rows/g=<refresh>/app_id=<tenant>/day=<day>/   pending rows of a range
    <root>/places/g=<refresh>/app_id=../block=../        script id -> its range
    <root>/state/<refresh>/                              the ranges: refresh, rows
    <root>/_committed/n=<ledger version>                 the refresh, written last

A script leaves the list when the feed brings a successful execution of it, and
comes in when it is new to the ledger. Where a return code is changed from
success to failure (which recording does not do) the script's executions are
looked up in the ledger. A crash before the marker leaves the last list.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplog.operators import ledger as led
from shiplog.operators.numbering import number_within, stored
from shiplog.session import freeze
from shiplog.sources import ledger_store as store

RANGE = ["app_id", "day"]
#: Script ids of one places folder.
BLOCK = 1 << 16
ROWS = "app_id string, day string, id_script bigint, folder string, file string, package_ts timestamp_ntz, script_no bigint, target_id string, rank bigint"
PLACES = "app_id string, block bigint, id_script bigint, day string"
STATE = "app_id string, day string, g string, n_rows bigint, written bigint"
_OUT = ["app_id", "id_script", "folder", "file", "package_ts", "script_no", "target_id"]


def _ranged(scripts: DataFrame) -> DataFrame:
    """``scripts`` with the range that each lies in; days sort as text."""
    day = F.coalesce(F.date_format("package_ts", "yyyyMMdd"), F.lit("0"))
    return scripts.select(*_OUT, day.alias("day"))


def refreshed(spark: SparkSession, root: str) -> int | None:
    """The ledger version that the view stands at."""
    done = [int(n) for n in store.names_in(spark, f"{root}/_committed", "n=")]
    return max(done, default=None)


def _state(spark: SparkSession, root: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], STATE)
    g = spark.read.text(f"{root}/_committed/n={version}", wholetext=True).first()["value"]
    return spark.read.schema(STATE).parquet(f"{root}/state/{g}")


def _read(spark: SparkSession, root: str, part: str, ddl: str) -> DataFrame:
    fs, p, _ = store._fs(spark, f"{root}/{part}")
    if not fs.exists(p):
        return spark.createDataFrame([], f"{ddl}, g string")
    return spark.read.schema(f"{ddl}, g string").parquet(f"{root}/{part}")


def _write(df: DataFrame, root: str, part: str, g: str, by: list[str]) -> None:
    df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(f"{root}/{part}/g={g}")


def _delta(spark: SparkSession, ledger_root: str, root: str, since: int, until: int) -> tuple[DataFrame, DataFrame]:
    """(scripts that are new to the list, (app_id, id_script, day) that leave
    it), from the feed."""
    known = _read(spark, root, "places", PLACES)
    place = lambda df: df.withColumn("block", F.floor(F.col("id_script") / BLOCK))
    written = place(freeze(_ranged(store.changed_rows(spark, ledger_root, "scripts", since, until)), "scripts"))
    # the places of the feed's ids; their folders are pruned by tenant and block
    ids = place(freeze(store.changed_rows(spark, ledger_root, "executions", since, until).select("app_id", "id_script", "rc"), "feed"))
    blocks = stored(written.select("app_id", "block").union(ids.select("app_id", "block")).distinct())
    near = freeze(known.join(blocks, ["app_id", "block"], "left_semi").select("app_id", "id_script", "day"), "near")
    fresh = written.drop("block").join(near.select("app_id", "id_script"), ["app_id", "id_script"], "left_anti")
    placed = near.unionByName(fresh.select("app_id", "id_script", "day"))
    tried = ids.groupBy("app_id", "id_script").agg(F.bool_or(F.col("rc") == 0).alias("done"))
    tried = freeze(tried.join(placed, ["app_id", "id_script"]).withColumn("done", F.coalesce("done", F.lit(False))), "tried")
    return stored(fresh), tried


def refresh(spark: SparkSession, ledger_root: str, root: str) -> int:
    """Bring the view to the newest ledger version; returns that version."""
    since, until = refreshed(spark, root), store.latest_version(spark, ledger_root)
    if until is None:
        raise FileNotFoundError(f"no committed ledger version below {ledger_root}")
    if since == until:
        return until
    g = f"{until}-{uuid.uuid4().hex}"
    state = _state(spark, root, since)
    added, tried = _delta(spark, ledger_root, root, since or 0, until)
    done = tried.where("done").select("app_id", "id_script")
    # a script outside the list that has a failure now but no success in the feed
    held = _rows(spark, root, state, tried.where("not done"))
    lost = tried.where("not done").join(held, ["app_id", "id_script"], "left_anti").join(added, ["app_id", "id_script"], "left_anti")
    lost = freeze(lost.select("app_id", "id_script", "day"), "lost")
    back = _returned(spark, ledger_root, lost, until)
    touched = stored(
        added.select(*RANGE).union(tried.where("done").select(*RANGE)).union(back.select(*RANGE)).distinct()
    )  # one row per range
    old = _rows(spark, root, state, touched).drop("rank", "g")
    now = old.unionByName(added).unionByName(back).join(done, ["app_id", "id_script"], "left_anti")
    ranked = number_within(now.withColumn("path", led.script_path()), RANGE, led.EXECUTION_ORDER, "rank").drop("path")
    _write(ranked.select(*[c.split()[0] for c in ROWS.split(", ")]), root, "rows", g, RANGE)
    places = added.select("app_id", F.floor(F.col("id_script") / BLOCK).alias("block"), "id_script", "day")
    _write(places, root, "places", g, ["app_id", "block"])
    sizes = _read(spark, root, "rows", ROWS).where(F.col("g") == g).groupBy(*RANGE, "g").agg(F.count(F.lit(1)).alias("n_rows"))
    news = touched.join(sizes, RANGE, "left").select(*RANGE, "g", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(until).cast("long").alias("written"))
    kept = state.join(touched, RANGE, "left_anti")
    kept.unionByName(news).hint("rebalance").write.mode("errorifexists").parquet(f"{root}/state/{g}")
    if not store.put_if_absent(spark, f"{root}/_committed/n={until}", g.encode()):
        raise store.Conflict(until, [])
    return until


def _rows(spark: SparkSession, root: str, state: DataFrame, ranges: DataFrame) -> DataFrame:
    """The view's rows in ``ranges`` (others are not read)."""
    wanted = state.where("n_rows > 0").join(ranges.select(*RANGE).distinct(), RANGE, "left_semi").select(*RANGE, "g")
    return _read(spark, root, "rows", ROWS).join(stored(wanted), [*RANGE, "g"])


def _returned(spark: SparkSession, ledger_root: str, lost: DataFrame, version: int) -> DataFrame:
    """Of the scripts ``lost``, those without a successful execution any more."""
    empty = spark.createDataFrame([], ", ".join(c for c in ROWS.split(", ") if not c.startswith("rank")))
    if lost.isEmpty():
        return empty
    tenants = [r["app_id"] for r in lost.select("app_id").distinct().collect()]  # one row per tenant of the feed
    state = store.read_ledger(spark, ledger_root, tenants, as_of=version)
    scripts = _ranged(state["scripts"]).join(lost.select("app_id", "id_script"), ["app_id", "id_script"], "left_semi")
    return stored(led.pending(scripts, state["executions"]))


def pending_list(spark: SparkSession, root: str, runs: DataFrame, app_id: str | None = None) -> DataFrame:
    """The list as the view holds it: the rows of ``led.pending_in_order``, and
    ``written``, the ledger version at which the row's range was written."""
    at = refreshed(spark, root)
    if at is None:
        raise FileNotFoundError(f"no refreshed view below {root}")
    state = _state(spark, root, at)
    if app_id is not None:
        state, runs = state.where(F.col("app_id") == app_id), runs.where(F.col("app_id") == app_id)
    # one row per range
    before = Window.partitionBy("app_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    ranges = state.withColumn("_before", F.coalesce(F.sum("n_rows").over(before), F.lit(0))).where("n_rows > 0").drop("n_rows")
    rows = _read(spark, root, "rows", ROWS).join(stored(ranges), [*RANGE, "g"])
    last = stored(led.last_run_ids(runs))
    run = (F.coalesce(F.col("_last_run"), F.lit(0)) + 1).cast("bigint")
    return rows.join(last, "app_id", "left").select(
        "app_id", run.alias("id_run"), (F.col("_before") + F.col("rank")).alias("num_order"), "id_script",
        "folder", "file", "target_id", "package_ts", "script_no", "written",
    )
