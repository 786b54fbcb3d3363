"""Layered key/value configuration.

A configuration is ``config(env, layer, ord, key, value)``: layer 0 is the
environment file, higher layers are overrides; ``ord`` is the position of
the line inside its layer. All operators are hash aggregates or joins on
``(env, key)``; nothing is ordered across the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiplog.operators.numbering import number_within
from shiplog.functions.predicates import (
    DEFAULT_TECH,
    default_if_blank,
    is_secret,
    override_key,
    override_value,
    shown_value,
    valid_override,
)

# Variable families, the repository technology key and the
# target kinds with their display label.
TARGET_PREFIX = "dpltgt_"
GROUP_PREFIX = "dbgrp_"
REPO_TECH_KEY = "deploy_repo_tech"
TARGET_TECH_PATTERN = r"(?i)^dpltgt_.*_tech\z"
ATOMIC_PATTERN = r"^dpltgt_(.*)_(db|user|password)\z"
COMPOSITE_PATTERN = r"^dbgrp_(.*)\z"
ATOMIC, COMPOSITE = "atomic", "composite"
LIST_BULLET = "    * "
COMPOSITE_LABEL = " (composite)"


def parse_overrides(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """P7 + P8: validity, key and value of ``key=value`` override texts."""
    t = F.col(text_col)
    return lines.select(
        "*",
        valid_override(t).alias("is_valid"),
        F.when(valid_override(t), override_key(t)).alias("key"),
        F.when(valid_override(t), override_value(t)).alias("value"),
    )


def overrides_as_layer(parsed: DataFrame, layer: int = 1) -> tuple[DataFrame, DataFrame]:
    """(valid overrides as a config layer, refused overrides)."""
    good = parsed.where("is_valid").select(
        "env", F.lit(layer).cast("int").alias("layer"), F.col("ord").cast("int"), "key", "value"
    )
    return good, parsed.where(~F.coalesce(F.col("is_valid"), F.lit(False))).drop("is_valid", "key", "value")


def split_app_ids(df: DataFrame, col: str = "app_id") -> tuple[DataFrame, DataFrame]:
    """P6 as a split: (rows with a valid tenant id, rejected rows)."""
    from shiplog.functions.predicates import valid_app_id

    flagged = df.withColumn("_ok", valid_app_id(col))
    return flagged.where("_ok").drop("_ok"), flagged.where(~F.col("_ok")).drop("_ok")


def redact(config: DataFrame) -> DataFrame:
    """The configuration with secret values masked."""
    return config.withColumn("value", shown_value(F.col("key"), F.col("value")))


def last_wins(config: DataFrame) -> DataFrame:
    """A4: per ``(env, key)`` the value of the highest ``(layer, ord)``."""
    return config.groupBy("env", "key").agg(
        F.max_by("value", F.struct("layer", "ord")).alias("value"),
        F.max("layer").alias("layer"),
    )


def effective_config(config: DataFrame) -> DataFrame:
    """Base layer overlaid by all override layers -> ``(env, key, value)``."""
    return last_wins(config).select("env", "key", "value")


def override_count(config: DataFrame) -> DataFrame:
    """A5: number of override lines per environment."""
    return config.groupBy("env").agg(F.count_if(F.col("layer") > 0).cast("bigint").alias("n_overrides"))


def change_report(config: DataFrame) -> DataFrame:
    """J4 + P9 + A5: effective value, base value and whether an override
    changed it, with secrets masked on both sides."""
    base = last_wins(config.where("layer = 0")).select(
        "env", "key", F.col("value").alias("base_value")
    )
    eff = last_wins(config)
    counts = override_count(config)
    return (
        eff.join(base, ["env", "key"], "left")
        .join(counts, "env", "left")
        .select(
            "env",
            "key",
            shown_value(F.col("key"), F.col("value")).alias("value"),
            shown_value(F.col("key"), F.col("base_value")).alias("base_value"),
            (F.col("layer") > 0).alias("overridden"),
            is_secret(F.col("key")).alias("is_secret"),
            "n_overrides",
        )
    )


def target_tech(config: DataFrame) -> DataFrame:
    """``(env, key, tech)`` for ``dpltgt_*_tech`` keys, case-insensitive,
    blanks trimmed."""
    return config.where(F.col("key").rlike(TARGET_TECH_PATTERN)).select(
        "env", "key", F.trim(F.col("value")).alias("tech")
    )


def techs_in_use(config_effective: DataFrame) -> DataFrame:
    """A2 + U2 + O5: distinct technologies per environment, including the
    repository technology, with their sorted position ``tech_no``.

    An empty technology means the default one, as for script execution.
    """
    per_target = target_tech(config_effective).select(
        "env", default_if_blank(F.col("tech"), DEFAULT_TECH).alias("tech")
    )
    repo = config_effective.groupBy("env").agg(
        F.max(F.when(F.col("key") == REPO_TECH_KEY, F.trim("value"))).alias("tech")
    ).select("env", default_if_blank(F.col("tech"), DEFAULT_TECH).alias("tech"))
    techs = per_target.unionByName(repo).distinct()
    # the distinct set per environment is tiny (one row per technology)
    w = Window.partitionBy("env").orderBy("tech")
    return techs.withColumn("tech_no", F.row_number().over(w).cast("bigint"))


def target_names(config: DataFrame) -> DataFrame:
    """Target names and kinds. ``dpltgt_<t>_{db,user,password}`` is an
    atomic target, ``dbgrp_<t>`` a composite one; the name match is greedy."""
    k = F.col("key")
    atomic = F.regexp_extract(k, ATOMIC_PATTERN, 1)
    composite = F.regexp_extract(k, COMPOSITE_PATTERN, 1)
    return (
        config.select(
            "env",
            F.when(k.startswith(TARGET_PREFIX), atomic)
            .when(k.startswith(GROUP_PREFIX), composite)
            .alias("target"),
            F.when(k.startswith(TARGET_PREFIX), F.lit(ATOMIC))
            .when(k.startswith(GROUP_PREFIX), F.lit(COMPOSITE))
            .alias("kind"),
        )
        .where(F.col("target").isNotNull() & (F.col("target") != ""))
    )


def target_list(config: DataFrame) -> DataFrame:
    """A3 + O6: one row per target; a name that is both kinds is atomic.
    ``label`` is the display line; ``target_no`` the sorted position."""
    kinds = target_names(config).groupBy("env", "target").agg(
        F.bool_or(F.col("kind") == ATOMIC).alias("_atomic")
    )
    listed = kinds.select(
        "env",
        "target",
        F.when(F.col("_atomic"), F.lit(ATOMIC)).otherwise(F.lit(COMPOSITE)).alias("kind"),
        F.concat(
            F.lit(LIST_BULLET),
            F.col("target"),
            F.when(F.col("_atomic"), F.lit("")).otherwise(F.lit(COMPOSITE_LABEL)),
        ).alias("label"),
    )
    # targets grow with the configuration: number them without a per-env window
    return number_within(listed, ["env"], ["target"], "target_no")
