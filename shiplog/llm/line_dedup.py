"""Site-relative line deduplication, on built-in expressions only.

A line of a document is boilerplate of its site when it stands on more than
``max_ratio`` of the site's pages and on at least ``min_pages`` of them. Lines
are compared by a 128-bit hash of the text between line ends without spaces,
tabs and carriage returns at either side. Pages that hold a line twice count
once.

Defined results: a null text stays null, an empty or blank line is never
boilerplate, pages without a site (null) form a site of their own, repeated
rows count as pages, an empty table gives an empty table, and all other
columns are passed on unchanged whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import freeze

MAX_RATIO = 0.05
MIN_PAGES = 3


def _key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(7), bare).alias("b"))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r")) == ""


def boilerplate(
    docs: DataFrame,
    site: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(site, keys): the keys of each site's boilerplate lines.

    Lines are counted per (site, line), pre-aggregated before the shuffle, so
    a site with a third of all pages is spread by its lines. A site has at most
    (lines per page / max_ratio) boilerplate lines, so its list is short
    however many pages it has.
    """
    pages = docs.select(F.col(site).alias("site"), F.col(text).alias("body"))
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    lines = pages.select(
        "site", F.explode(F.array_distinct(F.transform(F.filter(F.split("body", "\n"), lambda x: ~_blank(x)), _key))).alias("key")
    )
    counts = (
        lines.groupBy("site", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    )
    frequent = counts.alias("c").join(totals.alias("t"), F.col("c.site").eqNullSafe(F.col("t.site")))
    return (
        frequent.where(F.col("n") > F.col("pages") * max_ratio)
        .groupBy(F.col("c.site").alias("site"))
        .agg(F.collect_list("key").alias("keys"))
    )


def drop_boilerplate(
    docs: DataFrame,
    site: str = "source",
    text: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``.

    The small per-site table is stored first, so that Spark knows its size when
    it chooses the join.
    """
    keys = freeze(boilerplate(docs, site, text, max_ratio, min_pages), "boilerplate")
    inner = keys.select(F.col("site").alias("__site"), F.col("keys").alias("__keys"))
    joined = docs.join(inner, F.col(site).eqNullSafe(F.col("__site")), "left")
    kept = F.array_join(
        F.filter(F.split(F.col(text), "\n"), lambda x: _blank(x) | ~F.array_contains(F.col("__keys"), _key(x))), "\n"
    )
    cleaned = F.when(F.col("__keys").isNull() | F.col(text).isNull(), F.col(text)).otherwise(kept)
    return joined.select(*[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, doc_id: str = "doc_id", site: str = "source", text: str = "text", **limits) -> DataFrame:
    """One row per document: its lines, how many went, and the kept text's MD5."""
    both = drop_boilerplate(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(site).alias("site"), F.col(text).alias("before"), F.col(text).alias("after")),
        "site",
        "after",
        **limits,
    )
    count = lambda c: F.when(F.col(c).isNull() | (F.col(c) == ""), 0).otherwise(F.size(F.split(c, "\n")))
    return both.select(
        "doc_id",
        F.col("site").alias("source"),
        count("before").cast("long").alias("n_lines"),
        (count("before") - count("after")).cast("long").alias("n_dropped"),
        F.md5(F.coalesce("after", F.lit(""))).alias("kept_md5"),
    )


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM lines),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
counts AS (SELECT source, bare, count(DISTINCT doc_id) AS n FROM keyed WHERE bare <> '' GROUP BY source, bare),
bad AS (
  SELECT c.source, c.bare FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= {MIN_PAGES} AND c.n > t.pages * {MAX_RATIO}),
kept AS (
  SELECT k.doc_id, string_agg(k.line, chr(10) ORDER BY k.pos) AS body, count(*) AS n
  FROM keyed k LEFT JOIN bad b ON k.source IS NOT DISTINCT FROM b.source AND k.bare = b.bare
  WHERE b.bare IS NULL GROUP BY k.doc_id)
SELECT d.doc_id, d.source,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END
         - CASE WHEN coalesce(k.body, '') = '' THEN 0 ELSE k.n END AS n_dropped,
       md5(coalesce(k.body, '')) AS kept_md5
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
