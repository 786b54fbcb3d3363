"""The ledger on shared storage, as append-only versioned tables.

Parquet has no in-place update (``MERGE INTO`` needs a table format that is
not available here), and rewriting the whole ledger for every deployment
would copy all history each time. The ledger changes in a way that suits
appends: merging and opening a run only insert rows, and recording outcomes
changes the return code of some executions. So every commit appends only the
changed rows, in a folder of its own transaction::

    <root>/<table>/v=<transaction>/app_id=<tenant>/part-*.parquet
    <root>/_committed/v=<n>          (written last: the transaction's name, the
                                      version it had read, its tenants)

Several writers may work on one ledger. A version is the commit marker, which
is put if absent, whole and at once: of two writers that want version n one
gets it. The other looks at what was committed since the version it had read;
if that touches none of its tenants it tries n + 1, else its rows are based on
a state that is gone and :class:`Conflict` is raised (:func:`update_ledger`
reads again and retries). A compaction conflicts with any commit it has not
read. A commit is one marker for all its tables, so versions are never mixed.

Readers take the committed transactions only (partition pruning on ``v``), so a
failed or running commit is invisible. ``runs`` are the
union of their versions; ``executions`` and ``scripts`` keep the newest row
per key, a grouped aggregate on a unique key (it shuffles evenly). A tenant-scoped read prunes ``app_id`` directories too.
``compact`` writes the current state as a base version (its marker says
so); readers start from the newest base, so history does not
have to be re-read forever. :func:`changed_rows` and :func:`changes` are the
feed of what was written between two versions.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Mapping
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_TABLES = ("scripts", "runs", "executions")
COMMITTED = "_committed"
BASE = "_base"

SCRIPTS_DDL = (
    "app_id string, id_script bigint, folder string, file string, package_ts timestamp_ntz, "
    "package_comment string, script_no bigint, target_id string, is_finished boolean"
)
RUNS_DDL = "app_id string, id_run bigint, action string, run_ts timestamp_ntz, env string"
EXECUTIONS_DDL = (
    "app_id string, id_run bigint, id_script_execution bigint, id_script bigint, "
    "num_order bigint, target_id string, rc bigint, started_at timestamp_ntz"
)
DDL = {"scripts": SCRIPTS_DDL, "runs": RUNS_DDL, "executions": EXECUTIONS_DDL}
#: Tables whose rows can change, with their key.
KEYS = {"scripts": ["app_id", "id_script"], "executions": ["app_id", "id_script_execution"]}
#: The key of every table, for the change feed.
ROW_KEYS = {**KEYS, "runs": ["app_id", "id_run"]}


class Conflict(RuntimeError):
    """Another writer has committed rows of the same tenants."""

    def __init__(self, version: int, tenants: list[str]):
        super().__init__(f"version {version} changed {', '.join(map(str, tenants[:5])) or 'the ledger'} since it was read")
        self.version, self.tenants = version, tenants


def _columns(table: str) -> list[str]:
    return [c.split()[0] for c in DDL[table].split(", ")]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def names_in(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return [n[len(prefix) :] for n in names if n.startswith(prefix)]


def _versions_in(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in names_in(spark, path, "v=") if n.isdigit())


def put_if_absent(spark: SparkSession, path: str, body: bytes) -> bool:
    """Create ``path`` with its whole content at once; False if it exists."""
    parts = urlparse(path)
    folder, name = path.rsplit("/", 1)
    staged = f"{folder}/.{name}.{uuid.uuid4().hex}"
    if parts.scheme in ("", "file"):  # a link is made only where none is
        local = lambda x: unquote(urlparse(x).path) if parts.scheme else x
        os.makedirs(local(folder), exist_ok=True)
        with open(local(staged), "wb") as f:
            f.write(body)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(local(staged), local(path))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local(staged))
    fs, target, jvm = _fs(spark, path)
    source = jvm.org.apache.hadoop.fs.Path(staged)
    fs.mkdirs(target.getParent())
    out = fs.create(source, True)
    try:
        out.write(bytearray(body))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:  # a rename without overwriting is atomic in the store
        context.rename(source, target, never_over)
        return True
    except Exception:
        if not fs.exists(target):
            raise
        fs.delete(source, False)
        return False


def _entry(spark: SparkSession, root: str, v: int) -> dict:
    """A commit marker: transaction, version read, tenants (None: all), whether
    it is a base. An empty marker is one of a ledger written by number."""
    fs, p, jvm = _fs(spark, f"{root}/{COMMITTED}/v={v}")
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text else {"txn": str(v), "read": v - 1, "tenants": None, "base": v in _versions_in(spark, f"{root}/{BASE}")}


def _log(spark: SparkSession, root: str, versions: list[int]) -> dict[int, dict]:
    return {v: _entry(spark, root, v) for v in versions}


def _since_base(spark: SparkSession, root: str, versions: list[int]) -> dict[int, dict]:
    """The markers of the newest base among ``versions`` and what follows."""
    out: dict[int, dict] = {}
    for v in sorted(versions, reverse=True):
        out[v] = _entry(spark, root, v)
        if out[v]["base"]:
            break
    return out


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Version numbers with a commit marker, ascending (driver-side listing
    of one small folder)."""
    return _versions_in(spark, f"{root}/{COMMITTED}")


def latest_version(spark: SparkSession, root: str) -> int | None:
    done = committed_versions(spark, root)
    return done[-1] if done else None


def transactions(spark: SparkSession, root: str) -> list[str]:
    """The transactions that make up the current state, oldest first."""
    log = _since_base(spark, root, committed_versions(spark, root))
    return [log[v]["txn"] for v in sorted(log)]


def _table(spark: SparkSession, root: str, table: str, log: dict[int, dict]) -> DataFrame:
    """The rows that the versions of ``log`` wrote, with their version ``v``."""
    empty = spark.createDataFrame([], DDL[table]).withColumn("v", F.lit(None).cast("int"))
    # only the folders of the wanted versions are listed and read; a version
    # that did not touch the table has no folder
    have = set(names_in(spark, f"{root}/{table}", "v="))
    of = {entry["txn"]: v for v, entry in log.items() if entry["txn"] in have}
    if not of:
        return empty
    # explicit schema: a version with no rows has no files to infer from
    reader = spark.read.schema(f"{DDL[table]}, v string").option("basePath", f"{root}/{table}")
    df = reader.parquet(*[f"{root}/{table}/v={t}" for t in of]).withColumnRenamed("v", "_txn")
    numbers = spark.createDataFrame(list(of.items()), "_txn string, v int")  # a row per version
    # broadcast: a shuffle by transaction would put all rows of a version into one task
    return df.join(F.broadcast(numbers), "_txn").select(*_columns(table), "v")


def read_ledger(
    spark: SparkSession, root: str, app_id: str | list[str] | None = None, as_of: int | None = None
) -> dict[str, DataFrame]:
    """Current ledger state (optionally for some tenants, optionally as of a
    committed version). A tenant filter prunes ``app_id`` directories."""
    versions = [v for v in committed_versions(spark, root) if as_of is None or v <= as_of]
    if not versions:
        raise FileNotFoundError(f"no committed ledger version below {root}")
    # start from the newest compacted base at or before the wanted version
    log = _since_base(spark, root, versions)
    out = {}
    for t in LEDGER_TABLES:
        df = _table(spark, root, t, log)
        if isinstance(app_id, str):
            df = df.where(F.col("app_id") == app_id)
        elif app_id is not None:
            df = df.where(F.col("app_id").isin(list(app_id)))
        if t in KEYS:
            # newest row per key: max_by over the version number. Dealt by key first, so
            # that a task sorts one shuffle partition, not whatever a scan split holds
            value_cols = [c for c in _columns(t) if c not in KEYS[t]]
            latest = df.repartition(*KEYS[t]).groupBy(*KEYS[t]).agg(F.max_by(F.struct(*value_cols), F.col("v")).alias("_s"))
            df = latest.select(*KEYS[t], "_s.*")
        out[t] = df.select(*_columns(t))
    return out


def write_ledger(
    spark: SparkSession, root: str, changes: Mapping[str, DataFrame], base: bool = False, read_version: int | None = None
) -> int:
    """Append the given rows (new or changed) as the next version; returns it.
    With ``base`` the version holds the whole state, and readers start from it.

    ``read_version`` is the version that the rows are based on (the newest one
    unless given; 0 for none). :class:`Conflict` is raised, and nothing is
    visible, if a later version holds rows of the same tenants. Tables that are
    not given add nothing. The version number also skips numbers left behind
    by failed commits.
    """
    if read_version is None:
        read_version = latest_version(spark, root) or 0
    txn = uuid.uuid4().hex
    tenants: set[str] = set()
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for t, df in changes.items():
        if t not in DDL:
            continue
        types = dict(c.split() for c in DDL[t].split(", "))
        # optional columns a writer did not produce are stored as null
        cols = [
            F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in _columns(t)
        ]
        (
            df.select(*cols)
            .hint("rebalance", "app_id")  # few files a tenant; a large tenant is split
            .write.mode("errorifexists")
            .partitionBy("app_id")
            .parquet(f"{root}/{t}/v={txn}")  # a folder of its own: writers share no temporary files
        )
        tenants |= {unescape(n) for n in names_in(spark, f"{root}/{t}/v={txn}", "app_id=")}
    return _commit(spark, root, {"txn": txn, "read": read_version, "tenants": sorted(tenants), "base": base})


def _commit(spark: SparkSession, root: str, entry: dict) -> int:
    """Put the marker of the next version, unless a version since the one read
    conflicts."""
    seen = entry["read"]
    while True:
        done = committed_versions(spark, root)
        later = [v for v in done if v > seen]
        for v, other in sorted(_log(spark, root, later).items()):
            if entry["base"]:
                raise Conflict(v, other["tenants"] or [])
            if other["base"]:  # the same state, written anew
                continue
            own = set(entry["tenants"])
            both = own if other["tenants"] is None else own & set(other["tenants"])
            if both:
                raise Conflict(v, sorted(both))
        seen = max([seen, *later])
        taken = {*done, seen}
        for t in LEDGER_TABLES:
            taken |= set(_versions_in(spark, f"{root}/{t}"))
        v = max(taken) + 1
        if put_if_absent(spark, f"{root}/{COMMITTED}/v={v}", json.dumps(entry).encode()):
            return v


def update_ledger(
    spark: SparkSession,
    root: str,
    change: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]],
    app_id: str | list[str] | None = None,
    attempts: int = 20,
) -> int:
    """Commit ``change(state)``; when another writer was faster, on the state
    that it left, up to ``attempts`` times."""
    for left in range(attempts, 0, -1):
        at = latest_version(spark, root) or 0
        state = read_ledger(spark, root, app_id, as_of=at) if at else empty_ledger(spark)
        try:
            return write_ledger(spark, root, change(state), read_version=at)
        except Conflict:
            if left == 1:
                raise
    raise ValueError("attempts must be positive")


def _written(spark: SparkSession, root: str, since: int, until: int | None) -> dict[int, dict]:
    """The markers of the versions in (since, until] that changed rows."""
    versions = [v for v in committed_versions(spark, root) if v > since and (until is None or v <= until)]
    return {v: e for v, e in _log(spark, root, versions).items() if not e["base"]}


def changed_rows(spark: SparkSession, root: str, table: str, since: int, until: int | None = None) -> DataFrame:
    """The newest row of every key written after version ``since`` (up to
    ``until``), with the version ``v`` that wrote it. Reads the folders of these
    versions only; a compaction changes nothing."""
    rows = _table(spark, root, table, _written(spark, root, since, until))
    key = ROW_KEYS[table]
    values = [c for c in _columns(table) if c not in key]
    newest = rows.repartition(*key).groupBy(*key).agg(F.max("v").alias("v"), F.max_by(F.struct(*values), F.col("v")).alias("_s"))
    return newest.select(*key, "_s.*", "v").select(*_columns(table), "v")


def changes(spark: SparkSession, root: str, table: str, since: int, until: int | None = None) -> DataFrame:
    """The change feed: :func:`changed_rows` with ``change`` (``insert``, or
    ``update`` for keys that version ``since`` held) and ``old``, the row at
    that version. Of the older state only the tenants that changed are read."""
    rows = changed_rows(spark, root, table, since, until)
    key = ROW_KEYS[table]
    values = [c for c in _columns(table) if c not in key]
    known = [e["tenants"] for e in _written(spark, root, since, until).values()]
    tenants = None if None in known else sorted({t for k in known for t in k})
    done = any(v <= since for v in committed_versions(spark, root))
    before = (read_ledger(spark, root, tenants, as_of=since) if done else empty_ledger(spark))[table]
    old = before.select(*key, F.struct(*values).alias("old"))
    joined = rows.join(old, key, "left")
    return joined.withColumn("change", F.when(F.col("old").isNull(), "insert").otherwise("update"))


def compact(spark: SparkSession, root: str, prune: bool = False) -> int:
    """Write the current state as one new base version; readers start there.

    With ``prune`` the version folders older than the base are deleted
    afterwards (only do that when no reader needs ``as_of`` older states).
    """
    at = latest_version(spark, root)
    state = read_ledger(spark, root, as_of=at)
    v = write_ledger(spark, root, state, base=True, read_version=at)
    fs, _, jvm = _fs(spark, root)
    if prune:
        older = {e["txn"] for e in _log(spark, root, [n for n in committed_versions(spark, root) if n < v]).values()}
        for t in LEDGER_TABLES:
            for name in older.intersection(names_in(spark, f"{root}/{t}", "v=")):
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{t}/v={name}"), True)
    return v


def empty_ledger(spark: SparkSession) -> dict[str, DataFrame]:
    """A ledger with no rows (first deployment)."""
    return {t: spark.createDataFrame([], DDL[t]) for t in LEDGER_TABLES}


def fit(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the stored columns of ``table`` (missing optional
    columns as null)."""
    types = dict(c.split() for c in DDL[table].split(", "))
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in _columns(table)])


def read_or_empty(spark: SparkSession, root: str, app_id: str | list[str] | None = None) -> dict[str, DataFrame]:
    if latest_version(spark, root) is None:
        return empty_ledger(spark)
    return read_ledger(spark, root, app_id=app_id)
