"""J2 with data skipping: merge an inventory without reading the whole ledger.

Every ledger file of scripts has a row with its tenant, its least and greatest
folder and its highest id, and a Bloom filter of its script keys (``PROBES``
bits of at least ``BITS_PER_ROW`` a row, as bitmaps of 32,768 bits). Both are
built once per committed version and lie beside the ledger
(``<root>/_filters/<transaction>``), written by their own commit marker, so a
version whose index is missing or half written is read whole.

A merge probes the candidates against the files of their tenant whose folders
include theirs, and reads

* for the anti join, the files whose filter has all bits of some candidate;
* for finished increments, the files that hold a finished script and include a
  candidate's folder.

A filter has no false negatives, so the result is that of a full merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.operators import ledger as led
from shiplog.operators.numbering import stored
from shiplog.session import freeze
from shiplog.sources import ledger_store as store

PROBES = 4
BITS_PER_ROW = 10
#: Fixed value: bits of one bitmap of Spark's bitmap functions.
BITMAP_BITS = 32_768
FILES = "path string, app_id string, n_rows long, low string, high string, max_id long, has_finished boolean, bits long"
BLOOMS = "path string, bucket long, bitmap binary"


def _positions(bits: Column) -> Column:
    """The places of a key in a filter of ``bits`` bits, from 1."""
    places = [F.pmod(F.xxhash64(*led.SCRIPT_KEY, F.lit(k)), bits) + 1 for k in range(PROBES)]
    return F.array(*places)


def _bit(bitmap: Column, position: Column) -> Column:
    at = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1) == 1


def _indexed(spark: SparkSession, root: str) -> set[str]:
    return set(store.names_in(spark, f"{root}/_filters/_done", "t="))


def index(spark: SparkSession, root: str) -> int:
    """Build what committed versions lack; returns how many were indexed. Only
    key columns are read."""
    lacking = _lacking(spark, root)
    for txn in lacking:
        rows = spark.read.schema(store.SCRIPTS_DDL).option("basePath", f"{root}/scripts").parquet(f"{root}/scripts/v={txn}")
        rows = rows.select(*led.SCRIPT_KEY, "id_script", "is_finished", F.col("_metadata.file_path").alias("path"))
        files = rows.groupBy("path").agg(
            F.min("app_id").alias("app_id"), F.count(F.lit(1)).alias("n_rows"), F.min("folder").alias("low"), F.max("folder").alias("high"),
            F.max("id_script").alias("max_id"), F.coalesce(F.bool_or("is_finished"), F.lit(False)).alias("has_finished"),
        )
        whole = F.ceil(F.col("n_rows") * BITS_PER_ROW / BITMAP_BITS) * BITMAP_BITS
        files = freeze(files.withColumn("bits", whole.cast("long")), "files")
        probes = rows.join(files.select("path", "bits"), "path").select("path", F.explode(_positions(F.col("bits"))).alias("at"))
        blooms = probes.groupBy("path", F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
        # an index that was half written by a writer that is gone is replaced
        files.write.mode("overwrite").parquet(f"{root}/_filters/{txn}/files")
        blooms.write.mode("overwrite").parquet(f"{root}/_filters/{txn}/blooms")
        store.put_if_absent(spark, f"{root}/_filters/_done/t={txn}", b"")
    return len(lacking)


def _transactions(spark: SparkSession, root: str) -> list[str]:
    """The transactions that hold the current scripts (from the newest base)."""
    held = set(store.names_in(spark, f"{root}/scripts", "v="))
    return [t for t in store.transactions(spark, root) if t in held]


def _lacking(spark: SparkSession, root: str) -> list[str]:
    done = _indexed(spark, root)
    return [t for t in _transactions(spark, root) if t not in done]


def _side(spark: SparkSession, root: str, part: str, ddl: str, txns: list[str]) -> DataFrame:
    paths = [f"{root}/_filters/{t}/{part}" for t in txns]
    return spark.read.schema(ddl).parquet(*paths) if paths else spark.createDataFrame([], ddl)


def merge(spark: SparkSession, root: str, inventory: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(new rows, numbers of files: ``all``, ``read``, ``unindexed`` versions):
    the new rows of ``led.merge_increments`` for the stored ledger."""
    done, txns = _indexed(spark, root), _transactions(spark, root)
    ready, whole = [t for t in txns if t in done], [t for t in txns if t not in done]
    files = freeze(_side(spark, root, "files", FILES, ready), "files")
    blooms = _side(spark, root, "blooms", BLOOMS, ready)
    candidates = freeze(led.candidate_scripts(inventory), "candidates")
    folders = candidates.select("app_id", "folder").distinct()
    near = files.join(folders, "app_id").where((F.col("folder") >= F.col("low")) & (F.col("folder") <= F.col("high")))
    near = stored(near.select("path", "bits", "has_finished", "app_id", "folder"))  # a row per file and folder
    probes = candidates.select(*led.SCRIPT_KEY).join(near.select("path", "bits", "app_id", "folder"), ["app_id", "folder"])
    probes = probes.select("path", F.xxhash64(*led.SCRIPT_KEY, F.lit(-1)).alias("key"), F.explode(F.array_distinct(_positions(F.col("bits")))).alias("at"))
    found = probes.withColumn("bucket", F.bitmap_bucket_number("at")).join(blooms, ["path", "bucket"], "left")
    hits = found.groupBy("path", "key").agg(F.bool_and(F.coalesce(_bit(F.col("bitmap"), F.col("at")), F.lit(False))).alias("hit"))
    held = hits.where("hit").select("path").distinct()
    flagged = near.where("has_finished").select("path").distinct()
    # file names: metadata, one entry per ledger file that is read
    known = [r["path"] for r in held.collect()]
    ends = [r["path"] for r in flagged.collect()]

    def rows(paths: list[str]) -> DataFrame:
        sources = [*paths, *[f"{root}/scripts/v={t}" for t in whole]]
        if not sources:
            return spark.createDataFrame([], store.SCRIPTS_DDL)
        return spark.read.schema(f"{store.SCRIPTS_DDL}, v string").option("basePath", f"{root}/scripts").parquet(*sources)

    ids = files.select("app_id", F.col("max_id").alias("id")).union(rows([]).select("app_id", "id_script"))
    last_id = ids.groupBy("app_id").agg(F.max("id").alias("_last_id"))
    new_rows = led.new_scripts(candidates, rows(known), rows(ends), last_id)
    return new_rows, {"all": files.count(), "read": len(set(known) | set(ends)), "unindexed": len(whole)}
