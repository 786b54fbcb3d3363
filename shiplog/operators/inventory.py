"""Script inventory: exclusion, depth, and parsing of package and script names
(P1-P5).

An inventory is any DataFrame with a ``path`` column (relative to the source
root, with or without a leading ``./``). Everything here is a narrow
transformation: no shuffle, all built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.functions.paths import (
    base_name,
    depth,
    is_noise,
    last_folder,
    normalise_path,
    package_comment,
    package_stamp,
    parent_folder,
)


def normalise(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """Canonical relative paths."""
    return inventory.withColumn(path_col, normalise_path(path_col))


def exclude_noise(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """Drop hidden top folders, editor backups, repository scripts,
    temp and log files."""
    return inventory.where(~is_noise(path_col))


def min_depth(inventory: DataFrame, levels: int = 2, path_col: str = "path") -> DataFrame:
    """Keep files with at least ``levels - 1`` folders above them."""
    if levels == 2:
        return inventory.where(F.col(path_col).contains("/"))
    return inventory.where(depth(path_col) >= levels)


def filter_inventory(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """P1-P3 in the listing's order: normalise, then exclude, then depth."""
    return min_depth(exclude_noise(normalise(inventory, path_col), path_col), 2, path_col)


def parse_inventory(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """P4 + P5: split a (filtered) inventory into its parts.

    Adds ``folder``, ``file``, ``package_ts``, ``package_comment``,
    ``script_no``, ``target_id``, ``extension`` and ``reject_reason`` (null
    for a valid row). The timestamp orders packages, the number orders
    scripts inside a package.

    A script name is ``<digits>;<target>.<extension>``: the number ends at
    the first ``;``, the target at the next ``.`` (it is limited to
    identifier characters, as it names configuration variables), the
    extension is the rest and may be empty or contain dots. The parts are cut
    with string functions; only three short anchored checks use patterns.
    """
    p = F.col(path_col)
    name = base_name(p)
    pkg = last_folder(p)
    number = F.substring_index(name, ";", 1)
    rest = F.substring(name, F.length(number) + 2, F.length(name))
    target = F.substring_index(rest, ".", 1)
    well_formed = (
        name.contains(";")
        & rest.contains(".")
        & number.rlike(r"^[0-9]+\z")
        & target.rlike(r"^[A-Za-z0-9_]+\z")
    )
    parsed = inventory.select(
        "*",
        parent_folder(p).alias("folder"),
        name.alias("file"),
        package_stamp(pkg).alias("package_ts"),
        package_comment(pkg).alias("package_comment"),
        F.when(well_formed, number.try_cast("bigint")).alias("script_no"),
        F.when(well_formed, target).alias("target_id"),
        F.when(well_formed, F.substring(rest, F.length(target) + 2, F.length(rest))).alias("extension"),
    )
    reason = (
        F.when(F.col("package_ts").isNull(), F.lit("bad package folder"))
        .when(F.col("target_id").isNull(), F.lit("bad script name"))
        .when(~(F.col("script_no") > 0) | F.col("script_no").isNull(), F.lit("bad script number"))
    )
    out = parsed.withColumn("reject_reason", reason)
    # one-element explode: filters on the result (valid / rejected) stay
    # above it instead of re-running the parsing inside the filter
    return out.select(F.explode(F.array(F.struct(*out.columns))).alias("_r")).select("_r.*")


def parse_package(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """P4 alone: ``package_ts`` (null when malformed) and ``package_comment``."""
    pkg = last_folder(F.col(path_col))
    return inventory.select("*", package_stamp(pkg).alias("package_ts"), package_comment(pkg).alias("package_comment"))


def parse_script(inventory: DataFrame, path_col: str = "path") -> DataFrame:
    """P5 alone: ``script_no``, ``target_id``, ``extension`` (null when the
    name is malformed or the number is not positive)."""
    parsed = parse_inventory(inventory, path_col)
    keep = [c for c in inventory.columns] + ["script_no", "target_id", "extension"]
    return parsed.select(
        *[c for c in keep if c not in ("script_no", "target_id", "extension")],
        F.when(F.col("script_no") > 0, F.col("script_no")).alias("script_no"),
        F.when(F.col("script_no") > 0, F.col("target_id")).alias("target_id"),
        F.when(F.col("script_no") > 0, F.col("extension")).alias("extension"),
    )


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of ``parse_inventory`` output."""
    ok = parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = parsed.where(F.col("reject_reason").isNotNull())
    return ok, bad


def scan(inventory: DataFrame, path_col: str = "path") -> tuple[DataFrame, DataFrame]:
    """Filter and parse in one go: (valid scripts, rejects)."""
    return split_valid(parse_inventory(filter_inventory(inventory, path_col), path_col))
