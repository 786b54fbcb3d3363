"""Predicates and small value rules.

Regular expressions use ``\\z`` for "end of text": Java's ``$`` also matches
before a final line break, which would let ``"a\\n"`` pass as valid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Validation patterns and the masking text.
APP_ID_PATTERN = r"^[A-Za-z][A-Za-z0-9_-]*\z"
OVERRIDE_PATTERN = r"^(cfg|dpltgt|dbgrp)_[a-zA-Z_]+=[^=\s]*\z"
SECRET_KEY_PATTERN = r"passw(or)?d\z"
MASK = "*****"
DEFAULT_TECH = "oracle-sqlplus"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_app_id(app_id: Column | str) -> Column:
    """Tenant id starts with a letter, then letters, digits, ``_`` or ``-``.

    Null and empty are invalid (false, never null).
    """
    a = _c(app_id)
    return F.coalesce(a.rlike(APP_ID_PATTERN), F.lit(False))


def valid_override(text: Column | str) -> Column:
    """``<family>_<letters/underscores>=<value without = or blanks>``."""
    return F.coalesce(_c(text).rlike(OVERRIDE_PATTERN), F.lit(False))


def override_key(text: Column | str) -> Column:
    """Part before the first ``=``."""
    return F.regexp_extract(_c(text), r"^([^=]*)=", 1)


def override_value(text: Column | str) -> Column:
    """Part after the first ``=`` (may contain further ``=``)."""
    return F.regexp_replace(_c(text), r"^[^=]*=", "")


def split_override(text: Column | str) -> Column:
    """``struct(key, value)`` split at the first ``=``."""
    return F.struct(override_key(text).alias("key"), override_value(text).alias("value"))


def is_secret(key: Column | str) -> Column:
    """Keys ending in ``passwd`` or ``password``."""
    return F.coalesce(_c(key).rlike(SECRET_KEY_PATTERN), F.lit(False))


def shown_value(key: Column | str, value: Column | str) -> Column:
    """The value as it may be displayed; secrets are masked."""
    v = _c(value)
    return F.when(is_secret(key) & v.isNotNull(), F.lit(MASK)).otherwise(v)


def lnnvl(condition: Column) -> Column:
    """P10/F8: true when the condition is false *or unknown*."""
    return ~condition.eqNullSafe(F.lit(True))


def in_csv_list(item: Column | str, csv_list: Column | str) -> Column:
    """Membership in a comma-separated list; a null list has no members."""
    return F.coalesce(F.array_contains(F.split(_c(csv_list), ","), _c(item)), F.lit(False))


def default_if_blank(value: Column | str, default: str | Column) -> Column:
    """replace null *and* empty text with a default."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(_c(value), F.lit("")), d)
