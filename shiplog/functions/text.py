"""Value-to-text rendering and the enclosed-delimited record format.

Record layout (fixed values of the format):

* every field is written as ``@..`` + text + ``..@``;
* fields are separated by one tab;
* a record ends with a tab, then the terminator ``<eor>`` and a newline.

A null and an empty text both become an empty enclosure; loading turns both
back into null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the enclosed format.
OPEN = "@.."
CLOSE = "..@"
FIELD_SEP = "\t"
RECORD_END = "<eor>\n"

# Session text formats for the three time types.
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
ZONE_SUFFIX_UTC = " +00/00"

# One field of a record: optionally enclosed; an enclosure ends at the first
# ``..@`` that is followed by a tab or the end of the record.
FIELD_PATTERN = r"(?s)(?:^|(?<=\t))(?:@\.\.(.*?)\.\.@(?=\t|\z)|([^\t]*))"


def _ntz_text(col: Column, fraction: bool) -> Column:
    """Wall-clock text of a zone-less value without any zone conversion.

    ``date_format`` would first cast to a zoned timestamp in the session
    zone, which shifts times inside a daylight-saving gap; the value's own
    text form (``yyyy-MM-dd HH:mm:ss[.ffffff]``) does not.
    """
    text = col.cast("timestamp_ntz").cast("string")
    base = F.substring_index(text, ".", 1)  # years may have more than four digits
    if not fraction:
        return base
    frac = F.when(text.contains("."), F.substring_index(text, ".", -1)).otherwise(F.lit(""))
    return F.concat(base, F.lit("."), F.rpad(frac, 9, "0"))


def render_text(col: Column, data_type: T.DataType, declared: str | None = None) -> Column:
    """Text of a value under the export session formats.

    ``declared`` is the catalog type name (``DATE``, ``TIMESTAMP(6)``,
    ``TIMESTAMP(6) WITH TIME ZONE`` ...); when absent the Spark type decides.
    Numbers use ``.`` as decimal point and no grouping.
    """
    declared = (declared or "").upper()
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        if declared == "DATE" or (isinstance(data_type, T.DateType) and not declared):
            return _ntz_text(col, fraction=False)
        base = _ntz_text(col, fraction=True)
        # a zone-less value declared as zoned is taken as UTC
        return F.concat(base, F.lit(ZONE_SUFFIX_UTC)) if "WITH TIME ZONE" in declared else base
    if isinstance(data_type, T.TimestampType):
        if declared == "DATE":
            return F.date_format(col, DATE_FORMAT)
        base = F.date_format(col, TIMESTAMP_FORMAT)
        if declared and "WITH TIME ZONE" not in declared:
            return base
        # session-zone offset as +hh:mm, written as +hh/mm
        offset = F.regexp_replace(F.date_format(col, "xxx"), ":", "/")
        return F.concat(base, F.lit(" "), offset)
    if isinstance(data_type, T.StringType):
        return col
    return col.cast("string")


def enclose(text: Column) -> Column:
    """One enclosed field; null renders as an empty enclosure."""
    return F.concat(F.lit(OPEN), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def enclosed_record(fields: Sequence[Column]) -> Column:
    """The record body (fields joined by tabs, without the terminator)."""
    return F.concat_ws(FIELD_SEP, *[enclose(f) for f in fields])


def enclosed_expr(schema: T.StructType) -> Column:
    """P13 from a schema alone: all columns, in schema order, rendered by
    their Spark types (use the catalog-driven form to apply visibility rules
    and declared types)."""
    return enclosed_record([render_text(F.col(f.name), f.dataType) for f in schema.fields])


def ambiguous(text: Column) -> Column:
    """True when a value cannot be written unambiguously (no escape exists)."""
    return F.coalesce(
        text.contains(CLOSE + FIELD_SEP) | text.contains(RECORD_END),
        F.lit(False),
    )


def enclosed_parts(record: Column) -> Column:
    """All fields of a record body as an array (enclosures still on)."""
    return F.regexp_extract_all(record, F.lit(FIELD_PATTERN), 0)


def field_at(parts: Column, i: int) -> Column:
    """Field ``i`` (0-based) of ``enclosed_parts``: enclosure removed, empty
    and missing fields null."""
    raw = F.try_element_at(parts, F.lit(i + 1))
    n = F.length(raw)
    enclosed = raw.startswith(OPEN) & raw.endswith(CLOSE) & (n >= len(OPEN) + len(CLOSE))
    inner = F.when(enclosed, F.substring(raw, len(OPEN) + 1, n - len(OPEN) - len(CLOSE))).otherwise(raw)
    return F.nullif(inner, F.lit(""))


def split_enclosed(record: Column, n_fields: int) -> list[Column]:
    """The first ``n_fields`` fields of a record body.

    Enclosures are optional; tabs and newlines inside an enclosure are kept;
    text after the last expected field is ignored; missing fields and empty
    fields are null. (For many fields, project ``enclosed_parts`` once and
    use ``field_at`` on it, so the pattern runs once per record.)
    """
    parts = enclosed_parts(record)
    return [field_at(parts, i) for i in range(n_fields)]
