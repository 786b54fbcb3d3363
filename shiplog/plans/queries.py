"""Named jobs over the test tables, one per operator group of the survey.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the SQL of the same name in ``shiplog.plans.oracle``. Jobs that number
rows or join per-tenant facts store these while the DataFrame is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.functions.paths import normalise_path
from shiplog.functions.predicates import valid_app_id
from shiplog.functions.text import FIELD_SEP, RECORD_END, enclose, render_text
from shiplog.operators import catalog as cat_ops
from shiplog.operators import config as cfg_ops
from shiplog.operators import inventory as inv_ops
from shiplog.operators import ledger as led
from shiplog.operators import ordering as ord_ops
from shiplog.operators.numbering import number_within
from shiplog.plans import deploy, derived, merge_skipping, pending_view
from shiplog.session import TABLES, freeze, read_table, scratch_path
from shiplog.sources import config_files, enclosed, ledger_store, loader_file, tree
from shiplog.sources import execution_list as xl
from shiplog.sources.catalog import footer_value_counts
from shiplog.streaming import outcome_feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


@register("inventory_filter")
def inventory_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P3 over the events-derived inventory."""
    raw = derived.inventory_from_events(read_table(spark, sf_dir, "events"))
    return inv_ops.filter_inventory(raw).select("event_id", "user_id", "event_type", "path")


@register("inventory_parse")
def inventory_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P5 with reject reasons."""
    raw = derived.inventory_from_events(read_table(spark, sf_dir, "events"))
    parsed = inv_ops.parse_inventory(inv_ops.filter_inventory(raw))
    return parsed.select(
        "event_id",
        "path",
        "folder",
        "file",
        "package_ts",
        "package_comment",
        "script_no",
        "target_id",
        "extension",
        "reject_reason",
    )


@register("tree_listing")
def tree_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scripts' tree, written by tasks and listed back."""
    raw = derived.inventory_from_events(derived.spread_events(spark, sf_dir))
    root = scratch_path(spark, "tree")
    tree.make_tree(raw.select(normalise_path(F.col("path")).alias("path")), root)
    return tree.tree_inventory(spark, root).withColumn("depth", F.size(F.split("path", "/")).cast("bigint"))


# ---------------------------------------------------------------- ledger


@register("merge_increments")
def merge_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after merging the full inventory."""
    inv = derived.parsed_inventory(spark, sf_dir)
    scripts = derived.scripts_of(derived.known_part(inv))
    _, new_rows = led.merge_increments(scripts, inv)
    # merged ledger = known rows + new rows; flag them without a join
    known = scripts.select(*led.SCRIPT_COLUMNS, F.lit(False).alias("is_new"))
    return known.unionByName(new_rows.select(*led.SCRIPT_COLUMNS, F.lit(True).alias("is_new")))


@register("merge_skipping")
def merge_skipping_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 with data skipping: a ledger written in four turns (ten days of each
    month's packages a turn, then the last ten again), and an inventory of the
    last ten days. ``skipped`` tells that files of the ledger were not read."""
    inv = freeze(derived.parsed_inventory(spark, sf_dir).withColumn("third", F.least(F.floor((F.dayofmonth("package_ts") - 1) / 10), F.lit(2))), "thirds")
    known = derived.known_part(inv)
    root = scratch_path(spark, "ledger")
    for turn in (known.where("third = 0"), known.where("third = 1"), known.where("third = 2 and event_id % 2 = 0"), known.where("third = 2 and event_id % 2 = 1")):
        ledger_store.write_ledger(spark, root, {"scripts": derived.scripts_of(turn)})
    merge_skipping.index(spark, root)
    new_rows, files = merge_skipping.merge(spark, root, inv.where("third = 2 and event_id % 6 <> 5"))
    return new_rows.select(*led.SCRIPT_COLUMNS, F.lit(files["read"] < files["all"] or files["all"] == 0).alias("skipped"))


@register("pending_in_order")
def pending_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + W3: pending scripts numbered for each tenant's next run."""
    lg = derived.ledger_from_events(spark, sf_dir)
    out = led.pending_in_order(lg["scripts"], lg["executions"], lg["runs"])
    return out.select(
        "app_id", "id_run", "num_order", "id_script", "folder", "file", "target_id", "package_ts", "script_no"
    )


@register("run_create")
def run_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 + L3: the new run's execution list (8 columns + tenant and run)."""
    lg = derived.ledger_from_events(spark, sf_dir)
    run = led.create_run(lg["scripts"], lg["executions"], lg["runs"], "all")
    return led.execution_list(run["executions"], lg["scripts"])


@register("run_outcome_halt")
def run_outcome_halt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + W2 + L4: reported codes applied to open executions, then halt."""
    lg = derived.ledger_from_events(spark, sf_dir)
    open_execs = lg["executions"].withColumn("rc", F.lit(None).cast("bigint"))
    done = led.halt_status(led.apply_outcomes(open_execs, _repeated(lg["returns"])))
    return done.select("app_id", "id_run", "id_script_execution", "num_order", "rc", "status")


@register("outcome_feed")
def outcome_feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + L4 on a live feed: the reports in three drops, each failure first
    reported as a success by a retry, every code withdrawn and given again late."""
    lg = derived.ledger_from_events(spark, sf_dir)
    execs = lg["executions"].withColumn("rc", F.lit(None).cast("bigint"))
    codes = freeze(lg["returns"].join(lg["executions"].select("app_id", "id_run", "id_script_execution", "num_order"), ["app_id", "id_script_execution"]), "codes")
    opposite = F.when(F.col("rc") > 0, F.lit(0)).otherwise(F.lit(7)).cast("bigint")
    drops = [(opposite, 2), (F.col("rc"), 3), (opposite, 1)]  # code, minute of the report: the last drop comes late
    root = scratch_path(spark, "feed")
    for code, minute in drops:
        at = F.lit(f"2024-01-01 00:0{minute}:00").cast("timestamp_ntz")
        sent = codes.withColumn("rc", code).withColumn("reported_at", at)
        sent.unionByName(sent.where("num_order % 3 = 0")).write.mode("append").parquet(f"{root}/in")
        feed = outcome_feed.start_outcome_feed(spark, f"{root}/in", f"{root}/out", f"{root}/state", available_now=True)
        feed.awaitTermination()
    done = outcome_feed.live_status(execs, spark.read.parquet(f"{root}/out"))
    return done.select("app_id", "id_run", "id_script_execution", "num_order", "rc", "status")


@register("run_classify")
def run_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + P19 + P20 + L5: real / fake split and technology per execution."""
    lg = derived.ledger_from_events(spark, sf_dir)
    eff = cfg_ops.effective_config(derived.config_from_nations(spark, sf_dir))
    out = led.classify(lg["executions"], lg["runs"], eff)
    return out.select(
        "app_id", "id_run", "id_script_execution", "target_id", "env", "is_fake", "tech", "rc", "status"
    )


@register("sync_mark")
def sync_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sync run over the merged inventory, every execution a successful fake."""
    inv = derived.parsed_inventory(spark, sf_dir)
    lg = derived.ledger_from_events(spark, sf_dir, derived.known_part(inv))
    out = led.sync(lg["scripts"], lg["executions"], lg["runs"], inv)
    return out["executions"].select(
        "app_id", "id_run", "id_script_execution", "num_order", "id_script", "rc", "is_fake", "status"
    )


# ---------------------------------------------------------------- config


@register("app_id_check")
def app_id_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant ids made from customer names (even keys made valid)."""
    c = read_table(spark, sf_dir, "customer")
    app_id = F.when(F.col("c_custkey") % 2 == 0, F.replace("c_name", F.lit("#"), F.lit("_"))).otherwise(
        F.col("c_name")
    )
    return c.select("c_custkey", app_id.alias("app_id")).withColumn("is_valid", valid_app_id("app_id"))


@register("override_parse")
def override_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8 over override texts."""
    return cfg_ops.parse_overrides(derived.override_lines(spark, sf_dir)).select(
        "env", "ord", "text", "is_valid", "key", "value"
    )


@register("config_effective")
def config_effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + A4 + P9 + A5: effective settings with the change report."""
    return cfg_ops.change_report(derived.config_from_nations(spark, sf_dir))


@register("techs_in_use")
def techs_in_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 + A2 + U2 + O5."""
    eff = cfg_ops.effective_config(derived.config_from_nations(spark, sf_dir))
    return cfg_ops.techs_in_use(eff).select("env", "tech", "tech_no")


@register("target_list")
def target_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P22 + A3 + O6."""
    eff = cfg_ops.effective_config(derived.config_from_nations(spark, sf_dir))
    return cfg_ops.target_list(eff).select("env", "target", "kind", "label", "target_no")


# ---------------------------------------------------------------- ordering


@register("natural_order")
def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + O2: parts in the order of the number inside their brand."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    keyed = part.withColumn("brand_no", ord_ops.number_key("p_brand", r"#(\d+(?:\.\d+)?)"))
    return ord_ops.order_by_number(
        keyed, "p_brand", r"#(\d+(?:\.\d+)?)", "ord", tie_breakers=("p_partkey",)
    ).select("p_partkey", "p_brand", "brand_no", "ord")


@register("precedence_union")
def precedence_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names (global list) before supplier names (local list)."""
    g = read_table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    loc = read_table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return ord_ops.union_with_precedence(g, loc, "name", r"(\d+)").select("layer", "name", "ord")


# ---------------------------------------------------------------- catalog / export


@register("visible_columns")
def visible_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + P10 + P11 (+ O3 via column_id), with each column's values from the file footers."""
    cat = cat_ops.visible_columns(derived.catalog_fixture(spark, sf_dir))
    counts = footer_value_counts(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})
    return cat.join(counts, ["table_name", "column_name"]).select("table_name", "column_name", "column_id", "data_type", "n_values")


@register("column_list")
def column_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the projection of orders and of documents applied to their rows
    (with nulls put into a text column)."""
    lists = cat_ops.column_list(derived.catalog_fixture(spark, sf_dir)).where(F.col("table_name").isin("ORDERS", "DOCUMENTS"))
    texts = {r["table_name"]: r["column_list"] for r in lists.collect()}  # one row per table
    orders = read_table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.expr("if(o_orderkey % 5 = 0, null, o_orderstatus)"))
    docs = read_table(spark, sf_dir, "documents").withColumn("text", F.expr("if(doc_id % 7 = 0, null, text)"))
    parts = [
        df.select(F.lit(t).alias("table_name"), F.col(key).alias("id"), F.md5(F.expr(texts[t])).alias("record_md5"))
        for t, df, key in (("ORDERS", orders, "o_orderkey"), ("DOCUMENTS", docs, "doc_id"))
    ]
    return parts[0].unionByName(parts[1])


@register("loader_spec")
def loader_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 + P17 + P18 + W1: control files for every table; string lengths
    are measured from the data, so the spec accepts every row."""
    return cat_ops.loader_spec(derived.catalog_fixture(spark, sf_dir, measure_lengths=True))


EXPORTS = {"ORDERS": ("orders", ["o_orderkey"]), "LINEITEM": ("lineitem", ["l_orderkey", "l_linenumber"])}


@register("enclosed_export")
def enclosed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 + P14 + O4: export records of orders and lineitem with their
    position in the requested order."""
    cat = derived.catalog_fixture(spark, sf_dir)
    out = None
    for table, (name, order) in EXPORTS.items():
        # the range exchange of the numbering spreads the rows, and records
        # are rendered after it, in parallel
        df = read_table(spark, sf_dir, name)
        cols = [c for c, _ in enclosed.export_columns(df, cat, table)]
        # all exported columns break ties: rows equal in every one of them
        # give the same record, so the numbering is deterministic
        ties = [c for c in cols if c not in order]
        numbered = number_within(df.select(*cols), [], [*order, *ties], "seq")
        out_t = numbered.select(
            F.lit(table).alias("table_name"), "seq", enclosed.record_line(numbered, cat, table).alias("line")
        )
        out = out_t if out is None else out.unionByName(out_t)
    return out


@register("enclosed_roundtrip")
def enclosed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S6 + P15: documents and labels written in the enclosed format,
    loaded back with their types, and joined."""
    from pyspark.sql import types as T

    cat = derived.catalog_fixture(spark, sf_dir)
    loaded = {}
    for table, name, order in (("DOCUMENTS", "documents", ["doc_id"]), ("LABELS", "labels", ["doc_id"])):
        df = read_table(spark, sf_dir, name)
        cols = enclosed.export_columns(df, cat, table)
        path = scratch_path(spark, "export", name)
        enclosed.export_enclosed(df, order, path, table, cat)
        schema = T.StructType([df.schema[c] for c, _ in cols])
        good, _, _ = enclosed.load_enclosed(spark, path, schema)
        loaded[name] = good
    d, lab = loaded["documents"], loaded["labels"]
    return d.join(lab, "doc_id", "left").select("doc_id", "text", "lang", "source", "quality", "toxic")


# ---------------------------------------------------------------- execution list file


@register("execution_list_read")
def execution_list_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the ledger's execution list written as pipe-delimited text (with
    CR line ends, separator lines and pipes inside the last field) and read
    back."""
    lg = derived.ledger_from_events(spark, sf_dir)
    listing = led.execution_list(lg["executions"], lg["scripts"])
    n = F.col("num_order")
    listing = listing.withColumn(
        "add_info", F.element_at(F.array(*[F.lit(x) for x in ("", "x|", "a|b", "a|b|", "x||", "|")]), (n % 6 + 1).cast("int"))
    )
    rows = xl.render_execution_list(listing).withColumn(
        "value",
        F.when(F.col("value").rlike(r"^\d+\|\d*[048]\|"), F.concat("value", F.lit("\r"))).otherwise(
            F.col("value")
        ),
    )
    separators = listing.select("id_run").distinct().select(
        F.concat(F.lit("|run "), F.col("id_run").cast("string")).alias("value")
    )
    path = scratch_path(spark, "execution_list")
    rows.unionByName(separators).write.mode("overwrite").text(path)
    return xl.read_execution_list(spark, path)


@register("enclosed_roundtrip_times")
def enclosed_roundtrip_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S6 + P14: times with years of four and five digits, written and
    loaded back."""
    out = None
    for name, key, col, years in (("orders", "o_orderkey", "o_orderdate", 10_000), ("events", "event_id", "ts", 20_000)):
        shifted = F.when(F.col(key) % 3 == 0, F.col(col) + F.make_ym_interval(F.lit(years), F.lit(0))).otherwise(F.col(col))
        df = read_table(spark, sf_dir, name).select(F.col(key).alias("id"), shifted.cast("timestamp_ntz").alias("t"))
        path = scratch_path(spark, "times", name)
        enclosed.export_enclosed(df, ["id"], path, name)
        good, _, _ = enclosed.load_enclosed(spark, path, df.schema)
        t = F.col("t")
        parts = good.select(
            F.lit(name).alias("name"), "id", F.year(t).alias("y"), F.month(t).alias("mo"), F.day(t).alias("d"),
            F.hour(t).alias("h"), F.minute(t).alias("mi"), F.second(t).alias("s"),
        )
        out = parts if out is None else out.unionByName(parts)
    return out


# ---------------------------------------------------------------- the joined-up flow


def _tenant_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw script paths of tenants; every fifth under the name of one of the
    customers, which is no valid tenant id."""
    raw = derived.inventory_from_events(read_table(spark, sf_dir, "events"))
    customers = read_table(spark, sf_dir, "customer")
    names = customers.select("c_name", (F.col("c_custkey") - 1).alias("k"))
    named = raw.join(names, F.col("event_id") % max(1, customers.count()) == F.col("k"), "left")
    app = F.concat(F.lit("app"), (F.col("event_id") % 2).cast("string"))
    return named.select(F.when(F.col("event_id") % 5 == 0, F.coalesce("c_name", F.lit("9#"))).otherwise(app).alias("app_id"), "path")


@register("deploy_prepare")
def deploy_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants checked, scripts merged, a run of one
    environment opened, targets that it does not run stored as successful."""
    inv = derived.parsed_inventory(spark, sf_dir)
    ledger = derived.ledger_from_events(spark, sf_dir, derived.known_part(inv))
    env = read_table(spark, sf_dir, "region").where("r_regionkey = 1").first()["r_name"]
    config = cfg_ops.effective_config(derived.config_from_nations(spark, sf_dir))
    out = deploy.prepare(spark, ledger, _tenant_inventory(spark, sf_dir), "all", env=env, config=config)["changes"]
    runs = out["runs"].select("app_id", "id_run", "env")
    return out["executions"].join(runs, ["app_id", "id_run"]).select(
        "app_id", "id_run", "id_script_execution", "num_order", "id_script", "target_id", "env", "rc"
    )


def _recorded(spark: SparkSession, sf_dir: str) -> dict:
    ledger = derived.ledger_from_events(spark, sf_dir)
    still_open = ledger["executions"].withColumn("rc", F.lit(None).cast("bigint"))
    return deploy.record({**ledger, "executions": still_open}, _repeated(ledger["returns"]))


def _repeated(returns: DataFrame) -> DataFrame:
    """Every return code reported twice, a failure also as a success."""
    again = returns.withColumn("rc", F.when(F.col("rc") > 0, F.lit(0)).otherwise(F.col("rc")).cast("bigint"))
    return returns.unionByName(returns).unionByName(again)


@register("deploy_record")
def deploy_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + W2 + L4: all runs after the return codes, reported twice each."""
    out = _recorded(spark, sf_dir)
    reached = F.when(F.col("status") != led.NOT_REACHED, F.col("rc")).alias("rc")
    return out["status"].select("app_id", "id_run", "id_script_execution", "num_order", reached, "status")


@register("deploy_finished")
def deploy_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The increments that recording has finished."""
    return _recorded(spark, sf_dir)["finished"].select("app_id", "folder")


@register("ledger_versions")
def ledger_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions (scripts and runs, open executions, return codes),
    compacted and read back."""
    ledger = derived.ledger_from_events(spark, sf_dir)
    root = scratch_path(spark, "ledger")
    execs = ledger["executions"]
    ledger_store.write_ledger(spark, root, {"scripts": ledger["scripts"], "runs": ledger["runs"]})
    ledger_store.write_ledger(spark, root, {"executions": execs.withColumn("rc", F.lit(None).cast("bigint"))})
    ledger_store.write_ledger(spark, root, {"executions": execs.where("id_run % 2 = 0")})
    ledger_store.compact(spark, root)
    back = ledger_store.read_ledger(spark, root)["executions"]
    return back.select("app_id", "id_script_execution", "id_script", "num_order", "target_id", "rc")


def _written_in_turns(spark: SparkSession, sf_dir: str, after) -> str:
    """A ledger written in turns: open executions (of the first half of each
    month's packages three scripts in five); the rest and the return codes of
    the first half; a compaction; the return codes of the second half.
    ``after`` is called with the ledger's folder after every commit."""
    lg = derived.ledger_from_events(spark, sf_dir)
    scripts = lg["scripts"].withColumn("half", F.when(F.dayofmonth("package_ts") <= 15, 1).otherwise(2))
    execs = freeze(lg["executions"].join(scripts.select("app_id", "id_script", "half"), ["app_id", "id_script"]), "halves")
    unset = F.lit(None).cast("bigint")
    at_first = (F.col("half") == 2) | (F.col("id_script") % 5 < 3)
    root = scratch_path(spark, "ledger")
    turns = (
        {"scripts": scripts.where(at_first), "runs": lg["runs"], "executions": execs.where(at_first).withColumn("rc", unset)},
        {"scripts": scripts.where(~at_first), "executions": execs.where("half = 1")},
        None,
        {"executions": execs.where("half = 2")},
    )
    for rows in turns:
        if rows is None:
            ledger_store.compact(spark, root)
        else:
            ledger_store.write_ledger(spark, root, rows)
        after(root)
    return root


@register("ledger_changes")
def ledger_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The executions that versions two to four inserted or updated."""
    root = _written_in_turns(spark, sf_dir, lambda _: None)
    feed = ledger_store.changes(spark, root, "executions", since=1)
    return feed.select("app_id", "id_script_execution", "id_script", "rc", F.col("old.rc").alias("old_rc"), "change", F.col("v").cast("bigint").alias("v"))


@register("pending_maintained")
def pending_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + W3: the pending list as the view holds it, refreshed after every
    commit, and the version at which each row's range was last written."""
    view = scratch_path(spark, "pending_view")
    root = _written_in_turns(spark, sf_dir, lambda ledger: pending_view.refresh(spark, ledger, view))
    return pending_view.pending_list(spark, view, ledger_store.read_ledger(spark, root)["runs"])


@register("config_files")
def config_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configuration of the customers' environments, written by tasks
    and read back with its line numbers."""
    root = scratch_path(spark, "config")
    config_files.write_config_folders(derived.config_from_customers(spark, sf_dir), root)
    return config_files.read_config_folders(spark, root).withColumn("value", F.trim("value"))


@register("override_parse_at_size")
def override_parse_at_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8 over the override texts of the customers' environments."""
    return cfg_ops.parse_overrides(derived.override_lines_of_customers(spark, sf_dir)).select("env", "ord", "text", "is_valid", "key", "value")


@register("config_effective_at_size")
def config_effective_at_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + A4 + P9 + A5 over the customers' environments."""
    return cfg_ops.change_report(derived.config_from_customers(spark, sf_dir))


@register("techs_in_use_at_size")
def techs_in_use_at_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 + A2 + U2 + O5 over the customers' environments."""
    return cfg_ops.techs_in_use(cfg_ops.effective_config(derived.config_from_customers(spark, sf_dir)))


@register("target_list_at_size")
def target_list_at_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P22 + A3 + O6 over the customers' environments."""
    eff = cfg_ops.effective_config(derived.config_from_customers(spark, sf_dir))
    return cfg_ops.target_list(eff).select("env", "target", "kind", "label", "target_no")


@register("loader_spec_files")
def loader_spec_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control files as written, one per table."""
    path = scratch_path(spark, "spec")
    enclosed.write_loader_spec(cat_ops.loader_spec(derived.catalog_fixture(spark, sf_dir, measure_lengths=True)), path)
    return spark.read.text(path, wholetext=True).select("table_name", F.md5("value").alias("file_md5"))


@register("loader_file")
def loader_file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + S5 + S6: lineitem as one self-contained loader file, its records
    read back by byte ranges: number, byte offset and digest of each."""
    cat = derived.catalog_fixture(spark, sf_dir, measure_lengths=True)
    name, order = EXPORTS["LINEITEM"]
    df = read_table(spark, sf_dir, name)
    cols = [c for c, _ in enclosed.export_columns(df, cat, "LINEITEM")]
    path = scratch_path(spark, "loader") + ".ctl"
    loader_file.write_loader_file(df, [*order, *[c for c in cols if c not in order]], path, "LINEITEM", cat)
    records = loader_file.numbered(loader_file.read_loader_file(spark, path, split_bytes=4 << 20))
    return records.select("record_no", F.col("start").alias("byte_offset"), F.md5(F.concat("record", F.lit("<eor>"))).alias("record_md5"))


def _faulty_lines(df: DataFrame) -> DataFrame:
    """Records of (id, a, n, t); some hold a value that does not convert, are
    blank, or end after two fields."""
    i = F.col("id")
    n = F.concat(F.when(i % 11 == 1, F.lit("n")).otherwise(F.lit("")), F.col("n").cast("string"))
    t = F.when(i % 19 == 4, F.lit("never")).otherwise(render_text(F.col("t"), df.schema["t"].dataType))
    head, tail = [i.cast("string"), F.col("a")], [n, t]
    none = [F.lit(None).cast("string")] * 4
    line = lambda fields: F.concat(F.concat_ws(FIELD_SEP, *[enclose(f) for f in fields]), F.lit(FIELD_SEP))
    value = F.when(i % 13 == 2, line(none)).when(i % 17 == 3, line(head)).otherwise(line([*head, *tail]))
    return df.orderBy("id", "a", "n", "t").select(value.alias("value"))


@register("loader_rejects")
def loader_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of orders and events with planted faults, loaded with the
    first five skipped: the side, byte offset and reason of each."""
    kinds = {"orders": ("o_orderkey", "o_orderpriority", "o_custkey", "o_orderdate"), "events": ("event_id", "event_type", "user_id", "ts")}
    out = None
    for name, cols in kinds.items():
        own = [F.col(c).alias(a) for c, a in zip(cols, "iant", strict=True)]
        df = read_table(spark, sf_dir, name).select(own[0].alias("id"), *own[1:3], own[3].cast("timestamp_ntz").alias("t"))
        parts = scratch_path(spark, "rejects", name)
        _faulty_lines(df).write.option("lineSep", RECORD_END).text(parts)
        loader_file.concatenate(spark, b"begindata\n", parts, f"{parts}.dat")
        records = loader_file.read_loader_file(spark, f"{parts}.dat", split_bytes=1 << 20)
        sides = loader_file.load_records(records, df.schema, skip=5)
        sides = sides.select(F.lit(name).alias("name"), "record_no", "start", "side", "reason", "id", "a", "n", "t")
        out = sides if out is None else out.unionByName(sides)
    return out


@register("split_no_run")
def split_no_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions on targets that their environment runs, and the others."""
    lg = derived.ledger_from_events(spark, sf_dir)
    settings = led.run_settings(cfg_ops.effective_config(derived.config_from_nations(spark, sf_dir)))
    execs = lg["executions"].join(lg["runs"].select("app_id", "id_run", "env"), ["app_id", "id_run"])
    run, skip = led.split_runnable(execs, settings)
    cols = ["app_id", "id_script_execution", "target_id", "env"]
    return run.select(*cols, F.lit(True).alias("runs")).unionByName(skip.select(*cols, F.lit(False).alias("runs")))


@register("pre_phase")
def pre_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: executions that a runner has picked up are running until they report."""
    execs = derived.ledger_from_events(spark, sf_dir)["executions"]
    started = execs.where("num_order % 2 = 0").select("app_id", "id_script_execution", F.lit("2024-03-01 10:00:00").cast("timestamp_ntz").alias("started_at"))
    return led.status_started(led.mark_started(execs, started)).select("app_id", "id_script_execution", "rc", "status")
