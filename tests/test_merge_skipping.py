"""Merging with skipped files against the full merge."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shiplog.operators import ledger as led
from shiplog.plans import merge_skipping as skip
from shiplog.sources import ledger_store as store

INVENTORY = "app_id string, folder string, file string, package_ts timestamp_ntz, package_comment string, script_no long, target_id string"


def _script(app, i, day, finished=False):
    return (app, i, f"p{day:02d}", f"{i};t.sql", dt.datetime(2024, 1, day), None, i, "t", finished)


def _ledger(spark, root, turns):
    for turn in turns:
        store.write_ledger(spark, root, {"scripts": spark.createDataFrame(turn, store.SCRIPTS_DDL)})


def _inventory(spark, scripts):
    return spark.createDataFrame([(a, f, n, ts, c, no, t) for a, _, f, n, ts, c, no, t, _ in scripts], INVENTORY)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_rows_as_the_full_merge(spark, tmp_path, seed):
    """No candidate's file is passed over, with few bits and many collisions too."""
    rng = random.Random(seed)
    root = str(tmp_path / "led")
    every = [_script(rng.choice("ab"), i, rng.randint(1, 9), rng.random() < 0.1) for i in range(1, 161)]
    _ledger(spark, root, [every[:40], every[40:70], every[70:120]])
    assert skip.index(spark, root) == 3 and skip.index(spark, root) == 0
    scripts = store.read_ledger(spark, root)["scripts"]
    for candidates in (every[100:], [s for s in every if s[4].day == 3], every[30:35], [], every):
        inventory = _inventory(spark, candidates + candidates[:3])
        new, files = skip.merge(spark, root, inventory)
        assert rows(new) == rows(led.merge_increments(scripts, inventory)[1])
        assert files["unindexed"] == 0 and files["read"] <= files["all"]


def test_files_are_skipped_by_range_and_by_filter(spark, tmp_path):
    root = str(tmp_path / "led")
    early, late, other = ([_script("a", i, d) for i, d in pairs] for pairs in ([(k, 1) for k in range(50)], [(k, 20) for k in range(50, 100)], [(k, 20) for k in range(100, 150)]))
    _ledger(spark, root, [early, late, other, [_script("b", 500, 20)]])
    skip.index(spark, root)
    assert skip.merge(spark, root, _inventory(spark, [_script("a", 900, 10)]))[1] == {"all": 4, "read": 0, "unindexed": 0}
    # same folder as two files, in one of them only: the filter tells
    new, files = skip.merge(spark, root, _inventory(spark, other[:5]))
    assert (new.count(), files["read"]) == (0, 1)
    new, files = skip.merge(spark, root, _inventory(spark, [_script("a", 901, 20), _script("c", 1, 1)]))
    assert rows(new, "app_id", "id_script", "file") == [("a", 150, "901;t.sql"), ("c", 1, "1;t.sql")] and files["read"] == 0


def test_skipped_files_are_not_opened(spark, tmp_path):
    root = str(tmp_path / "led")
    _ledger(spark, root, [[_script("a", 1, 1)], [_script("a", 2, 20)]])
    skip.index(spark, root)
    files = spark.read.parquet(f"{root}/_filters/{store.transactions(spark, root)[0]}/files").collect()
    path = files[0]["path"].removeprefix("file:").replace("//", "/")
    os.truncate(path, 0)
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    new, _ = skip.merge(spark, root, _inventory(spark, [_script("a", 2, 20), _script("a", 3, 20)]))
    assert rows(new, "id_script", "file") == [(3, "3;t.sql")]


def test_versions_without_an_index_are_read_whole(spark, tmp_path):
    root = str(tmp_path / "led")
    _ledger(spark, root, [[_script("a", 1, 1), _script("a", 2, 2, True)], [_script("a", 7, 1)]])
    inventory = _inventory(spark, [_script("a", 1, 1), _script("a", 7, 1), _script("a", 8, 1), _script("a", 9, 2)])
    new, files = skip.merge(spark, root, inventory)
    assert rows(new, "id_script", "file") == [(8, "8;t.sql")] and files == {"all": 0, "read": 0, "unindexed": 2}
    # an index that was half written counts for nothing and is built again
    os.makedirs(f"{root}/_filters/{store.transactions(spark, root)[0]}/files")
    assert rows(skip.merge(spark, root, inventory)[0], "id_script") == [(8,)]
    assert skip.index(spark, root) == 2
    assert rows(skip.merge(spark, root, inventory)[0], "id_script") == [(8,)]


def test_filters_of_several_bitmaps(spark, tmp_path):
    root = str(tmp_path / "led")
    ids = spark.range(1, 8001).select(
        F.lit("a").alias("app_id"), F.col("id").alias("id_script"), F.lit("p").alias("folder"), F.concat(F.col("id").cast("string"), F.lit(";t.sql")).alias("file"),
        F.lit(None).cast("timestamp_ntz").alias("package_ts"), F.lit(None).cast("string").alias("package_comment"), F.col("id").alias("script_no"),
        F.lit("t").alias("target_id"), F.lit(False).alias("is_finished"),
    )
    store.write_ledger(spark, root, {"scripts": ids.coalesce(1)})
    skip.index(spark, root)
    blooms = spark.read.parquet(f"{root}/_filters/{store.transactions(spark, root)[0]}/blooms")
    assert blooms.select("bucket").distinct().count() == 3
    more = ids.unionByName(ids.withColumn("file", F.concat(F.lit("x"), "file")))
    assert skip.merge(spark, root, more)[0].count() == 8000
