"""Benchmark the headline jobs; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPS`` (default 7). Each job is built from scratch and
fully executed (``noop`` sink, nothing collected) once as warm-up and then
``BENCH_REPS`` times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from shiplog.plans.queries import QUERIES  # noqa: E402
from shiplog.session import build_session, read_table, scratch_path, scratch_scope  # noqa: E402
from shiplog.sources import enclosed  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


BYTES_WRITTEN: dict[str, int] = {}


def _bytes_under(spark, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def enclosed_lineitem(spark, sf_dir):
    """S5 + S6 on lineitem: export in key order, load back, verify count."""
    df = read_table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "bench", "lineitem")
    enclosed.export_enclosed(df, ["l_orderkey", "l_linenumber"], path, "LINEITEM")
    BYTES_WRITTEN["enclosed_roundtrip_lineitem"] = _bytes_under(spark, path)
    good, bad, _ = enclosed.load_enclosed(spark, path, df.schema)
    return good.agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))


JOBS = {
    "inventory_parse": QUERIES["inventory_parse"],
    "pending_in_order": QUERIES["pending_in_order"],
    "run_outcome_halt": QUERIES["run_outcome_halt"],
    "enclosed_export": QUERIES["enclosed_export"],
    "enclosed_roundtrip_lineitem": enclosed_lineitem,
    "config_effective": QUERIES["config_effective"],
    "merge_increments": QUERIES["merge_increments"],
    "target_list": QUERIES["target_list"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "7"))
    only = [a for a in sys.argv[1:] if a in JOBS]
    spark = build_session("shiplog-bench", cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2)))), driver_memory="16g")
    times: dict[str, float] = {}
    for name, job in JOBS.items():
        if only and name not in only:
            continue
        samples = []
        for i in range(reps + 1):
            with scratch_scope(spark):  # scratch tables are removed after each run
                t0 = time.perf_counter()
                run_noop(job(spark, sf_dir))
                dt = time.perf_counter() - t0
            if i:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_median_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "spark": spark.version,
                "driver_memory": spark.conf.get("spark.driver.memory"),
                "bytes_written": BYTES_WRITTEN,
                "reps": reps,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
