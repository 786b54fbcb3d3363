"""SURVEY section 5 laws, on relations derived from the driver's tables."""

from pyspark.sql import functions as F

from helpers import SF_SMALL
from shiplog.operators import config as cfg
from shiplog.operators import ledger as led
from shiplog.plans import derived
from shiplog.session import read_table, scratch_path
from shiplog.sources import enclosed


def test_merge_twice_is_merge_once(spark):
    scripts = derived.scripts_of(derived.known_part(derived.parsed_inventory(spark, SF_SMALL)))
    inv = derived.valid_inventory(read_table(spark, SF_SMALL, "events"))
    once, _ = led.merge_increments(scripts, inv)
    _, again = led.merge_increments(once, inv)
    assert again.count() == 0


def test_after_sync_nothing_is_pending(spark):
    lg = derived.ledger_from_events(spark, SF_SMALL)
    inv = derived.valid_inventory(read_table(spark, SF_SMALL, "events"))
    out = led.sync(lg["scripts"], lg["executions"], lg["runs"], inv)
    execs = lg["executions"].unionByName(out["executions"].drop("is_fake", "status"))
    assert led.pending(out["scripts"], execs).count() == 0


def test_effective_config_ignores_row_order(spark):
    conf = derived.config_from_nations(spark, SF_SMALL)
    a = sorted(tuple(r) for r in cfg.effective_config(conf).collect())
    shuffled = conf.orderBy(F.rand(7)).repartition(5)
    b = sorted(tuple(r) for r in cfg.effective_config(shuffled).collect())
    assert a == b and len(a) == 111


def test_export_then_load_gives_the_rows_back(spark):
    orders = read_table(spark, SF_SMALL, "orders")
    path = scratch_path(spark, "law-orders")
    rejects = enclosed.export_enclosed(orders, ["o_orderkey"], path, "ORDERS")
    good, bad, discard = enclosed.load_enclosed(spark, path, orders.schema)
    assert rejects.count() == 0 and bad.count() == 0 and discard.count() == 0
    assert good.exceptAll(orders).count() == 0 and orders.exceptAll(good).count() == 0
