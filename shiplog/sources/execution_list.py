"""S3: the pipe-delimited execution list (8 positional fields).

Reading rules: CR counts as a line end, the 8th field takes the rest of the
line, one trailing ``|`` at the end of that field is dropped if it is the only
one there, missing fields are empty, lines with an empty first field are skipped, empty text is null.
A last line without a line end is kept (dropping it would lose work).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Field names and types of the list, in position order.
FIELDS = [
    ("id_script_execution", "bigint"),
    ("num_order", "bigint"),
    ("id_script", "bigint"),
    ("id_increment", "bigint"),
    ("target_id", "string"),
    ("script_folder", "string"),
    ("script_file", "string"),
    ("add_info", "string"),
]


def split_execution_lines(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(typed rows, refused lines) of text lines (one list line each); a line
    whose id or order is not a number is refused."""
    parts = F.split(F.col(col), r"\|", len(FIELDS))
    raw = [F.try_element_at(parts, F.lit(i + 1)) for i in range(len(FIELDS))]
    # the delimiter at the end goes only when the last field holds no other
    one = F.substring_index(raw[-1], "|", 1)
    raw[-1] = F.when(raw[-1] == F.concat(one, F.lit("|")), one).otherwise(raw[-1])
    typed, bad = [], F.lit(False)
    for r, (name, dtype) in zip(raw, FIELDS):
        text = F.nullif(r, F.lit(""))
        value = text if dtype == "string" else text.try_cast(dtype)
        bad = bad | (text.isNotNull() & value.isNull())
        typed.append(value.alias(name))
    used = lines.where(F.coalesce(raw[0], F.lit("")) != "")
    return used.where(~bad).select(*typed), used.where(bad).select(F.col(col).alias("line"))


def parse_execution_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """The typed rows of :func:`split_execution_lines`."""
    return split_execution_lines(lines, col)[0]


def read_execution_list(spark: SparkSession, path: str) -> DataFrame:
    """Read list files; the text source ends lines at LF, CR or CRLF."""
    return parse_execution_lines(spark.read.text(path))


def render_execution_list(listing: DataFrame) -> DataFrame:
    """The sink side: one ``value`` line per row, fields joined by ``|``."""
    return listing.select(
        F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in FIELDS]).alias("value")
    )
