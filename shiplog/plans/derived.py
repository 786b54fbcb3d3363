"""Relations derived from the test tables (FIXTURES.md section B).

The test data holds no script trees, ledgers or config files, so these are
made from the driver's tables with fixed rules; the same rules are written in
SQL in ``shiplog.plans.oracle`` so both engines see identical inputs. All work
is Spark-side and grows with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.operators.inventory import scan
from shiplog.operators.numbering import number_within
from shiplog.session import freeze, read_table

# ---------------------------------------------------------------- B1 inventory


def inventory_from_events(events: DataFrame) -> DataFrame:
    """B1: one script path per event: ``(event_id, user_id, event_type, path)``."""
    eid = F.col("event_id")
    # wall-clock text of the zone-less ts (no session-zone conversion)
    t = F.col("ts").cast("string")
    hour_stamp = F.concat(
        F.substring(t, 1, 4), F.substring(t, 6, 2), F.substring(t, 9, 2), F.lit("-"), F.substring(t, 12, 2), F.lit("00")
    )
    stamp = F.when(eid % 41 == 1, F.lit("20241399-0000")).otherwise(hour_stamp)
    comment = F.when(eid % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(";"), F.col("event_type")))
    folder = (
        F.when(eid % 29 == 1, F.lit("./.hidden/"))
        .when(eid % 31 == 1, F.lit("./"))
        .otherwise(F.concat(F.lit("./rel/"), stamp, comment, F.lit("/")))
    )
    target = F.when(eid % 23 == 0, F.lit("deploy_repo")).otherwise(
        F.concat(F.lit("t"), (F.col("user_id") % 7).cast("string"))
    )
    ext = (
        F.when(eid % 11 == 1, F.lit("sql.tmp"))
        .when(eid % 13 == 1, F.lit("log"))
        .when(eid % 17 == 1, F.lit("sql.~bak"))
        .when(eid % 19 == 1, F.lit("bak~"))
        .when(eid % 4 == 0, F.lit("sql"))
        .when(eid % 4 == 1, F.lit("pck"))
        .when(eid % 4 == 2, F.lit("vw"))
        .otherwise(F.lit("trg"))
    )
    name = F.when(eid % 37 == 1, F.lit("readme.txt")).otherwise(
        F.concat(F.lpad(eid.cast("string"), 8, "0"), F.lit(";"), target, F.lit("."), ext)
    )
    # the one-element explode keeps later filters from re-building the path
    # once per predicate that reads it
    return events.select(
        "event_id", "user_id", "event_type", F.explode(F.array(F.concat(folder, name))).alias("path")
    )


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' columns that an inventory needs, dealt over all tasks: the
    table may be few row groups, and its paths cost far more than its reading."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return events.repartition(2 * spark.sparkContext.defaultParallelism, "event_id", "ts")


def valid_inventory(events: DataFrame) -> DataFrame:
    """``inv``: valid parsed scripts plus a tenant ``app_id``."""
    good, _ = scan(inventory_from_events(events))
    return good.withColumn("app_id", F.concat(F.lit("app"), (F.col("event_id") % 2).cast("string")))


# ---------------------------------------------------------------- B3/B4 ledger


def _scripts(inv: DataFrame) -> DataFrame:
    return inv.select(
        "app_id",
        F.col("event_id").alias("id_script"),
        "folder",
        "file",
        "package_ts",
        "package_comment",
        "script_no",
        "target_id",
        (F.hour("package_ts") % 2 == 0).alias("is_finished"),
    )


def parsed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``inv``, parsed once and stored: ledger jobs read it several times."""
    return freeze(valid_inventory(spread_events(spark, sf_dir)), "inventory")


def known_part(inv: DataFrame) -> DataFrame:
    """The scripts that a partial ledger knows (the others are new)."""
    return inv.where(F.col("event_id") % 3 != 1)


def scripts_of(inv: DataFrame) -> DataFrame:
    """B3 ``scripts`` alone."""
    return _scripts(inv)


def ledger_from_events(spark: SparkSession, sf_dir: str, inv: DataFrame | None = None) -> dict[str, DataFrame]:
    """B3 + B4: ``scripts``, ``executions``, ``runs`` and ``returns`` of the
    given scripts (all valid ones by default).

    ``num_order`` is numbered per (tenant, run) with the skew-safe numbering;
    ``id_script_execution`` = ``id_run * 2^40 + num_order``.
    """
    inv = parsed_inventory(spark, sf_dir) if inv is None else inv
    scripts = _scripts(inv)
    eid = F.col("event_id")
    rc = (
        F.when(eid % 10 == 9, F.lit(None).cast("bigint"))
        .when((F.col("event_type") == "error") & (F.col("user_id") % 3 == 0) & (eid % 50 == 2), F.lit(1))
        .otherwise(F.lit(0))
        .cast("bigint")
    )
    numbered = number_within(
        inv.select(
            "app_id",
            (F.col("user_id") % 10).alias("id_run"),
            F.col("event_id").alias("id_script"),
            "target_id",
            "package_ts",
            "script_no",
            "path",
            rc.alias("rc"),
        ),
        ["app_id", "id_run"],
        ["package_ts", "script_no", "path"],
        "num_order",
    )
    executions = numbered.select(
        "app_id",
        "id_run",
        (F.col("id_run") * (1 << 40) + F.col("num_order")).alias("id_script_execution"),
        "id_script",
        "num_order",
        "target_id",
        "rc",
    )
    region = read_table(spark, sf_dir, "region")
    runs = (
        executions.groupBy("app_id", "id_run")
        .agg(F.count(F.lit(1)).alias("n_scripts"))
        .join(region, F.col("id_run") % 5 == F.col("r_regionkey"), "left")
        .select(
            "app_id",
            "id_run",
            F.when(F.col("id_run") % 4 == 3, F.lit("sync")).otherwise(F.lit("all")).alias("action"),
            F.make_timestamp_ntz(
                F.lit(2024), F.lit(2), F.col("id_run").cast("int") + 1, F.lit(0), F.lit(0), F.lit(0)
            ).alias("run_ts"),
            F.col("r_name").alias("env"),
        )
    )
    returns = executions.where(F.col("rc").isNotNull()).select("app_id", "id_script_execution", "rc")
    return {"scripts": scripts, "executions": executions, "runs": runs, "returns": returns}


# ---------------------------------------------------------------- B2 config


def config_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: layered configuration ``(env, layer, ord, key, value)``: a target per
    nation, an environment per region.

    Layer 0 is the environment file, layer 1 the command-line overrides;
    ``ord`` is the position inside the layer.
    """
    region = read_table(spark, sf_dir, "region")
    nation = read_table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    targets = nation.select(F.col("r_name").alias("env"), F.col("n_nationkey").alias("n"), F.col("n_name").alias("name"))
    return _config(targets, region.select(F.col("r_name").alias("env"), F.col("r_regionkey").alias("r")))


def customer_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(env, n, name, r)``: a target per customer. One environment holds a third
    of them, every other one those of five neighbouring keys."""
    n = F.col("c_custkey")
    r = F.when(n % 3 == 0, F.lit(0)).otherwise((n - n % 5) / 5).cast("long")
    env = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), r.cast("string")))
    return read_table(spark, sf_dir, "customer").select(env.alias("env"), n.alias("n"), F.col("c_name").alias("name"), r.alias("r"))


def config_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 at size: the same rules over the customers' environments."""
    targets = customer_targets(spark, sf_dir)
    return _config(targets.drop("r"), targets.select("env", "r").distinct())


def _config(targets: DataFrame, envs: DataFrame) -> DataFrame:
    """The rows of targets (env, n, name) and of environments (env, r)."""
    n = F.col("n")
    nm = F.translate(F.lower("name"), "0123456789#", "abcdefghij_")
    tech_by_n = lambda k: F.element_at(F.array(F.lit("oracle-sqlplus"), F.lit("spark-sql"), F.lit("")), (k % 3 + 1).cast("int"))
    def row(layer, ord_, key, value, keep):
        return F.struct(
            F.lit(layer).cast("int").alias("layer"),
            ord_.cast("int").alias("ord"),
            key.alias("key"),
            value.alias("value"),
            keep.alias("keep"),
        )

    target = lambda suffix: F.concat(F.lit("dpltgt_"), nm, F.lit(suffix))
    rows = F.array(
        row(0, n * 10 + 1, target("_tech"), tech_by_n(n), F.lit(True)),
        row(0, n * 10 + 2, target("_db"), F.concat(F.lit("db"), n.cast("string")), n % 4 != 3),
        row(0, n * 10 + 3, target("_password"), F.concat(F.lit("pw"), n.cast("string")), n % 2 == 0),
        row(0, n * 10 + 4, F.concat(F.lit("dbgrp_"), nm), F.lit("x"), n % 3 == 0),
        row(1, n, target("_db"), F.concat(F.lit("ovr"), n.cast("string")), n % 2 == 0),
        row(1, n + 100, target("_db"), F.concat(F.lit("last"), n.cast("string")), n % 6 == 0),
    )
    target_rows = (
        targets.select("env", F.explode(rows).alias("x"))
        .where("x.keep")
        .select("env", "x.layer", "x.ord", "x.key", "x.value")
    )
    # every environment: dpltgt_t<n>_tech for n < 6, the no-run list, the repository's
    # technology and a technology key in upper case
    k = F.col("k")
    env_rows = (
        envs.select("env", "r", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("k"))
        .select(
            "env",
            F.lit(0).alias("layer"),
            F.when(k < 6, k + 300).otherwise(k + 394).cast("int").alias("ord"),
            F.when(k < 6, F.concat(F.lit("dpltgt_t"), k.cast("string"), F.lit("_tech")))
            .when(k == 6, F.lit("cfg_target_no_run"))
            .when(k == 7, F.lit("deploy_repo_tech"))
            .otherwise(F.lit("DPLTGT_Upper_TECH"))
            .alias("key"),
            F.when(k < 6, tech_by_n(k))
            .when(k == 6, F.lit("t1,t3"))
            .when(k == 7, F.when(F.col("r") % 2 == 0, F.lit("postgres")).otherwise(F.lit(" ")))
            .otherwise(F.concat(F.lit("tech"), F.col("r").cast("string")))
            .alias("value"),
        )
    )
    return target_rows.unionByName(env_rows).select(
        "env", F.col("layer").cast("int"), F.col("ord").cast("int"), "key", "value"
    )


def override_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Override texts for P7/P8: the layer-1 ``key=value`` lines plus invalid
    lines made from raw nation names (they contain digits)."""
    cfg = config_from_nations(spark, sf_dir).where("layer = 1")
    good = cfg.select("env", "ord", F.concat("key", F.lit("="), "value").alias("text"))
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    bad = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("env"),
        (F.col("n_nationkey") + 1000).cast("int").alias("ord"),
        F.concat(F.lit("dpltgt_"), F.col("n_name"), F.lit("_db=x")).alias("text"),
    )
    return good.unionByName(bad)


def override_lines_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Override texts at size: layer-1 lines, and one invalid line per customer."""
    good = config_from_customers(spark, sf_dir).where("layer = 1").select("env", "ord", F.concat("key", F.lit("="), "value").alias("text"))
    bad = customer_targets(spark, sf_dir).select("env", (F.col("n") + 1000).cast("int").alias("ord"), F.concat(F.lit("dpltgt_"), "name", F.lit("_db=x")).alias("text"))
    return good.unionByName(bad)


# ---------------------------------------------------------------- B5 catalog


def catalog_fixture(spark: SparkSession, sf_dir: str, measure_lengths: bool = False) -> DataFrame:
    """The catalog of the 14 test tables (from their parquet schemas)
    with the fixture's type, owner, length and flag rules applied.

    ``data_length`` is 10 x column_id, except that with ``measure_lengths``
    string columns get the longest value in bytes, measured from the data
    (the length a loader spec needs)."""
    from shiplog.session import TABLES
    from shiplog.sources.catalog import column_catalog

    tables = {t: read_table(spark, sf_dir, t) for t in TABLES}
    cat = column_catalog(spark, tables, measure_lengths=measure_lengths)
    nm = F.lower("column_name")
    cid = F.col("column_id")
    data_type = (
        F.when(nm == "html", F.lit("XMLTYPE"))
        .when(nm == "props", F.lit("CLOB"))
        .when(nm == "embedding", F.lit("BLOB"))
        .when(nm == "label", F.lit(None).cast("string"))
        .when(nm == "lang", F.lit("CHAR"))
        .when(nm == "role", F.lit("NCHAR"))
        .when(nm == "text", F.lit("NVARCHAR2"))
        .when(nm == "l_shipdate", F.lit("DATE"))
        .when(nm == "o_orderdate", F.lit("TIMESTAMP(6) WITH TIME ZONE"))
        .when(nm == "ts", F.lit("TIMESTAMP(6)"))
        .when(F.col("spark_type") == "string", F.lit("VARCHAR2"))
        .otherwise(F.lit("NUMBER"))
    )
    return cat.select(
        "table_name",
        "column_name",
        "column_id",
        data_type.alias("data_type"),
        F.when(nm == "html", F.lit("SYS")).alias("data_type_owner"),
        (
            F.when(F.col("spark_type") == "string", F.col("data_length")).otherwise(cid * 10)
            if measure_lengths
            else cid * 10
        )
        .cast("int")
        .alias("data_length"),
        F.when(nm == "html", F.lit("YES"))
        .when(nm == "l_tax", F.lit("YES"))
        .when(cid % 2 == 1, F.lit("NO"))
        .alias("virtual_column"),
        F.when(nm == "n_chars", F.lit("YES")).when(cid % 2 == 0, F.lit("NO")).alias("hidden_column"),
        "spark_type",
    )
