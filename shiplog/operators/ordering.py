"""Natural ordering by an embedded number (O1, O2) and ordered union by
precedence (U1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.functions.paths import base_name
from shiplog.operators.numbering import number_within

# Fixed value: the number after the first dash of a name, decimals allowed.
DASH_NUMBER = r"^[^-]*-(\d+(?:\.\d+)?)"


def sort_list(spec: str) -> list[Column]:
    """A caller-supplied ordering list such as ``"a, b desc, c asc"``."""
    out = []
    for item in (x.strip() for x in spec.split(",")):
        if not item:
            continue
        parts = item.split()
        c = F.col(parts[0])
        direction = parts[1].lower() if len(parts) > 1 else "asc"
        if direction not in ("asc", "desc"):
            raise ValueError(f"bad ordering item {item!r}")
        out.append(c.desc() if direction == "desc" else c.asc())
    return out


def number_key(text: Column | str, pattern: str = DASH_NUMBER, on_base_name: bool = True) -> Column:
    """O1 key: the first group of ``pattern`` as a decimal, 0 when absent or
    not numeric. By default only the base name is searched, so a dash in a
    folder name does not shift the order."""
    t = F.col(text) if isinstance(text, str) else text
    src = base_name(t) if on_base_name else t
    found = F.regexp_extract(src, pattern, 1)
    return F.coalesce(F.when(found != "", found.try_cast("decimal(38,9)")), F.lit(0).cast("decimal(38,9)"))


def order_by_number(
    df: DataFrame,
    col: str,
    pattern: str = DASH_NUMBER,
    rank_col: str = "ord",
    tie_breakers: tuple[str, ...] = (),
    on_base_name: bool = True,
) -> DataFrame:
    """O1: rank rows by the embedded number, then the whole text, then the
    given unique columns; the rank is a column (order is data, not layout)."""
    keyed = df.withColumn("_num_key", number_key(col, pattern, on_base_name))
    return number_within(keyed, [], ["_num_key", col, *tie_breakers], rank_col).drop("_num_key")


def union_with_precedence(
    global_df: DataFrame,
    local_df: DataFrame,
    col: str,
    pattern: str = DASH_NUMBER,
    same_location: bool = False,
    rank_col: str = "ord",
) -> DataFrame:
    """Global entries first, then local ones, each in natural order.

    When both lists come from the same location the global copy is skipped,
    so nothing runs twice.
    """
    parts = [local_df.withColumn("layer", F.lit(1))]
    if not same_location:
        parts.insert(0, global_df.withColumn("layer", F.lit(0)))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    keyed = both.withColumn("_num_key", number_key(col, pattern, on_base_name=True))
    return number_within(keyed, [], ["layer", "_num_key", col], rank_col).drop("_num_key")
