"""Plan-shape checks: the properties that matter at scale, not just results."""

import contextlib
import io

import __spark_entry__ as E
from helpers import SF_SMALL
from shiplog.session import scratch_path
from shiplog.sources import ledger_store


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # let AQE settle the final plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_key_joins_are_broadcast(spark):
    # tenants and runs are few and hot: no shuffle join may partition by them
    for name in ("pending_in_order", "run_outcome_halt", "run_classify", "sync_mark", "merge_increments"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "SortMergeJoin" not in plan, name


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["inventory_filter"](spark, SF_SMALL))
    schema_lines = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schema_lines and all("props" not in line and "value" not in line for line in schema_lines)


def test_tenant_read_prunes_partitions(spark):
    root = scratch_path(spark, "plan-ledger")
    scripts = spark.createDataFrame(
        [("a", 1, "f", "1;t.sql", None, None, 1, "t", False), ("b", 1, "f", "1;t.sql", None, None, 1, "t", False)],
        ledger_store.SCRIPTS_DDL,
    )
    ledger_store.write_ledger(spark, root, {"scripts": scripts})
    plan = _plan(ledger_store.read_ledger(spark, root, app_id="a")["scripts"])
    part = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("app_id" in line for line in part), part
