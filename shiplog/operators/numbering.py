"""Skew-safe row numbering, and stored fact tables for joins.

``row_number() OVER (PARTITION BY g ORDER BY k)`` puts every row of a group
into one task. Execution orders are numbered per tenant and run, and a single
run may hold a third of all rows, so the plain window does not scale.

``number_within`` gives the same numbers with bounded tasks and one shuffle
of the rows:

1. range-partition on ``(g, k)`` and sort inside each partition: a hot group
   is cut into several partitions of similar size (Spark samples the keys
   for the bounds), and every partition holds a contiguous key range;
2. ``monotonically_increasing_id`` then encodes (partition, position in the
   partition) for each row, in key order, without another shuffle. The rows
   are written once as a parquet table in the shared checkpoint folder, so
   the ids are data: they cannot change between the two uses below or after
   a lost task, and the lineage is cut;
3. a small table with one row per (partition, group) "piece" holds the
   piece's first position and the number of rows of the same group in
   earlier partitions (a grouped count and a window over pieces);
4. rank = position - first position of the piece + 1 + earlier rows.

The piece table has at most (groups + partitions) rows; it is joined back on
(partition, group). It is stored first, so Spark broadcasts it when it is
small (the numbered rows are then not shuffled again) and otherwise joins on
keys that are balanced (one piece is at most one partition).

Ties must be broken by the caller (the order keys must be unique within a
group) so that the numbering does not depend on arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplog.session import freeze

_MID = "__row_id"
_PID = "__range_pid"
_POS = "__pos"
_CNT = "__piece_rows"
_BASE = "__piece_base"
_POS_BITS = 33  # monotonically_increasing_id: partition index above bit 33


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def number_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1, 2, ... per group ``by`` in ``order`` (bigint).

    ``by`` are column names (may be empty for one global sequence); ``order``
    are names or sort expressions (``F.col(c).desc()``).
    """
    by = list(by)
    keys = [*_cols(by), *_cols(order)]
    # Without an explicit count AQE may merge neighbouring ranges toward the
    # advisory partition size (still contiguous key ranges, so positions stay
    # valid); spark.sql.shuffle.partitions is the upper limit.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    frozen = freeze(
        ranged.sortWithinPartitions(*keys)
        .withColumn(_MID, F.monotonically_increasing_id()),
        "numbering",
    )
    located = frozen.select(
        "*",
        F.shiftright(F.col(_MID), _POS_BITS).cast("int").alias(_PID),
        F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias(_POS),
    ).drop(_MID)

    pieces = located.groupBy(_PID, *by).agg(
        F.min(_POS).alias("__first"), F.count(F.lit(1)).alias(_CNT)
    )
    earlier = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        F.col(_PID).alias("__p" + _PID),
        *[F.col(c).alias(f"__p_{i}") for i, c in enumerate(by)],
        (F.coalesce(F.sum(_CNT).over(earlier), F.lit(0)) - F.col("__first")).alias(_BASE),
    )
    pieces = stored(pieces)
    cond = [F.col(_PID) == F.col("__p" + _PID)] + [
        F.col(c).eqNullSafe(F.col(f"__p_{i}")) for i, c in enumerate(by)
    ]
    joined = located.join(pieces, cond, "left")
    return joined.select(
        *df.columns,
        (F.col(_POS) + F.col(_BASE) + 1).cast("bigint").alias(name),
    )


def stored(df: DataFrame) -> DataFrame:
    """A per-tenant, per-run or per-folder fact table, written to the shared
    checkpoint folder and read back.

    It is computed once, its lineage is cut, and Spark knows its size in bytes
    when it plans the join: a table under its own broadcast threshold is
    broadcast, a larger one is joined with a shuffle (and skew splitting), and
    nothing is collected here.
    """
    return freeze(df, "side")
