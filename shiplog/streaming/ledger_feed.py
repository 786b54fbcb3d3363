"""Continuous ledger merge with Structured Streaming.

Inventory listings arrive as text files (one ``app_id<TAB>path`` line per
script). Each micro-batch is merged into the ledger (L1) and committed as a
new snapshot version. The merge is idempotent, so a batch that is replayed
after a failure (at-least-once ``foreachBatch``) adds nothing twice. Runs
are not created here: opening a run is an explicit deployment step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiplog.operators.numbering import stored
from shiplog.plans.deploy import commit, merge_only
from shiplog.sources.ledger_store import read_or_empty


def inventory_stream(spark: SparkSession, source_dir: str) -> DataFrame:
    """Streaming ``DF(app_id, path)`` from listing files dropped in a folder."""
    lines = spark.readStream.format("text").load(source_dir)
    parts = F.split(F.col("value"), "\t", 2)
    return lines.select(parts.getItem(0).alias("app_id"), parts.getItem(1).alias("path")).where(
        F.col("path").isNotNull()
    )


def start_ledger_feed(
    spark: SparkSession,
    source_dir: str,
    ledger_root: str,
    checkpoint_location: str,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the feed; each non-empty micro-batch writes one ledger version."""

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # only the tenants of this batch are merged; the join lets Spark prune
        # the tenant folders at run time
        tenants = stored(batch.select("app_id").distinct())
        whole = read_or_empty(spark, ledger_root)
        ledger = {t: df.join(tenants, "app_id", "left_semi") for t, df in whole.items()}
        out = merge_only(ledger, batch)
        commit(spark, ledger_root, out)

    writer = (
        inventory_stream(spark, source_dir)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
