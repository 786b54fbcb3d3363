"""Path expressions for script inventories (P1-P3, F16 and the name parts).

All functions take and return ``Column`` objects, so they stay inside
whole-stage codegen and push no work to Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalise_path(path: Column | str) -> Column:
    """Strip a leading ``./`` (both listing styles end up identical)."""
    return F.regexp_replace(_c(path), r"^\./", "")


def base_name(path: Column | str) -> Column:
    """Last path component (the file name)."""
    return F.substring_index(_c(path), "/", -1)


def parent_folder(path: Column | str) -> Column:
    """Everything before the last ``/``; empty for a bare name."""
    p = _c(path)
    return F.when(
        p.contains("/"), F.substring(p, F.lit(1), F.length(p) - F.length(base_name(p)) - 1)
    ).otherwise(F.lit(""))


def last_folder(path: Column | str) -> Column:
    """Name of the folder holding the file (the package folder)."""
    return F.substring_index(parent_folder(path), "/", -1)


def depth(path: Column | str) -> Column:
    """Number of components of a normalised path."""
    return F.size(F.split(_c(path), "/"))


# The exclusion rules of the listing, one per line. They are
# joined into one pattern over the normalised path, so a row is tested with a
# single regular-expression pass. ``[^/]`` keeps a rule inside the base name.
NOISE_RULES = [
    r"^\.[^/]*/",  # first component starts with a dot
    r"\.~[^/]{3}\z",  # name ends with .~ and 3 characters
    r"\.[^/]{3}~\z",  # name ends with . and 3 characters and ~
    r";deploy_repo\.[^/]*\z",  # script of the repository target itself
    r"\.tmp\z",  # temporary file
    r"\.log\z",  # log file
]
NOISE_PATTERN = "(?s)" + "|".join(f"(?:{r})" for r in NOISE_RULES)


def is_noise(path: Column | str) -> Column:
    """P1 on a normalised path: true for entries the inventory leaves out.

    Case-sensitive, as the listing rules are. The first component rule only
    looks at the first component; names starting with ``_`` or ``.`` deeper in
    the tree are kept.
    """
    return _c(path).rlike(NOISE_PATTERN)


def package_stamp(folder_name: Column | str) -> Column:
    """F16: ``yyyymmdd-hh24mi[;comment]`` -> ``timestamp_ntz`` (null when invalid).

    The digits are rearranged to ISO text and cast straight to
    ``timestamp_ntz``; going through a zoned timestamp would move wall-clock
    times that fall into a daylight-saving gap.
    """
    f = _c(folder_name)
    stamp = F.substring_index(f, ";", 1)
    part = lambda pos, n: F.substring(stamp, pos, n)
    iso = F.concat(
        part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "),
        part(10, 2), F.lit(":"), part(12, 2), F.lit(":00"),
    )
    # try_cast keeps a malformed stamp as null instead of failing the job
    return F.when(stamp.rlike(r"^\d{8}-\d{4}\z"), iso.try_cast("timestamp_ntz"))


def package_comment(folder_name: Column | str) -> Column:
    """Optional informative part after the first ``;`` of a package folder."""
    f = _c(folder_name)
    return F.when(f.contains(";"), F.substring(f, F.length(F.substring_index(f, ";", 1)) + 2, F.length(f)))
