"""Benchmark decontamination by size-partitioned MinHash containment search,
on built-in expressions only.

A document is contaminated by a test item when it holds at least
``min_similarity`` of the item's distinct five-word shingles. Words are runs
of letters and digits of the lower-cased text.

Search: items are partitioned by size (powers of two of their shingle count).
The MinHash sketch of an item holds its smallest shingle hashes, as many as a
partition's largest item may lack, plus one. By the pigeonhole principle a
document that reaches the threshold holds at least one hash of the sketch, so
the search loses nothing, and documents with too few shingles for an item are
passed over. Verification counts the item's shingles, as text, in each
candidate document.

Defined results: null or empty texts and items of under five words match
nothing, repeated rows of one id count as one document (its best row), null
ids are an id of their own, other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import MIN_SIMILARITY, SHINGLE_WORDS, freeze


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _at(n: Column) -> Column:
    """Positions of the shingles of ``n`` words (from 1)."""
    return F.when(n >= SHINGLE_WORDS, F.sequence(F.lit(1), n - (SHINGLE_WORDS - 1))).otherwise(F.array().cast("array<int>"))


def _hashes(w: str) -> Column:
    return F.transform(_at(F.size(w)), lambda i: F.xxhash64(*[F.get(F.col(w), i + (j - 1)) for j in range(SHINGLE_WORDS)]))


def _shingles(w: str) -> Column:
    return F.array_distinct(
        F.transform(_at(F.size(w)), lambda i: F.concat_ws(" ", *[F.get(F.col(w), i + (j - 1)) for j in range(SHINGLE_WORDS)]))
    )


def item_sketches(items: DataFrame, item_id: str = "item_id", text: str = "text", min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """(item_id, size, need, hash): one row per sketch entry.

    ``need`` is the smallest number of shared shingles that reaches the
    threshold. An item of partition p (2**(p-1) < size <= 2**p) gets
    2**p - ceil(2**p * threshold) + 1 entries, at least as many as it may lack.
    """
    w = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w"))
    h = w.select("item_id", F.array_sort(F.array_distinct(_hashes("w"))).alias("h")).withColumn("size", F.size("h")).where("size > 0")
    top = F.pow(F.lit(2), F.ceil(F.log2("size")))
    entries = (top - F.ceil(top * min_similarity - 1e-9) + 1).cast("int")
    return h.select(
        "item_id",
        "size",
        F.ceil(F.col("size") * min_similarity - 1e-9).cast("int").alias("need"),
        F.explode(F.slice("h", F.lit(1), entries)).alias("hash"),
    )


def candidates(docs: DataFrame, sketches: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, item_id) pairs that share a sketch entry."""
    w = docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("w"))
    h = w.select("doc_id", F.greatest(F.size("w") - (SHINGLE_WORDS - 1), F.lit(0)).alias("n"), F.explode(_hashes("w")).alias("hash"))
    return h.join(sketches, "hash").where(F.col("n") >= F.col("need")).select("doc_id", "item_id").distinct()


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every match."""
    sketches = freeze(item_sketches(items, item_id, item_text, min_similarity), "sketches")
    pairs = freeze(candidates(docs, sketches, doc_id, text), "candidates")
    body = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    tests = items.select(F.col(item_id).alias("__item"), words(F.col(item_text)).alias("iw")).select("__item", _shingles("iw").alias("want"))
    wanted = pairs.join(tests, F.col("item_id").eqNullSafe(F.col("__item"))).select("doc_id", "item_id", "want")
    found = (
        body.join(wanted, F.col("__id").eqNullSafe(F.col("doc_id")))
        .select("doc_id", "item_id", "want", words(F.col("__text")).alias("dw"))
        .select(
            "doc_id",
            "item_id",
            F.size("want").cast("long").alias("n_shingles"),
            F.size(F.array_intersect("want", _shingles("dw"))).cast("long").alias("n_shared"),
        )
        .groupBy("doc_id", "item_id", "n_shingles")
        .agg(F.max("n_shared").alias("n_shared"))
    )
    ratio = F.col("n_shared") / F.col("n_shingles")
    return found.where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * min_similarity - 1e-9)).withColumn("containment", ratio)


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    bad = freeze(contaminated(docs, items, doc_id=doc_id, text=text, **options).select(F.col("doc_id").alias("__bad")).distinct(), "contaminated")
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col("__bad")), "left_anti")


_W = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
_S = "list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i+4], ' ')))"
ORACLE = f"""
WITH d AS (SELECT doc_id, unnest({_S}) AS s FROM (SELECT doc_id, {_W} AS w FROM documents)),
     i0 AS (SELECT item_id, {_S} AS ss FROM (SELECT item_id, {_W} AS w FROM benchmark)),
     i AS (SELECT item_id, len(ss) AS n_shingles, unnest(ss) AS s FROM i0),
     hit AS (SELECT d.doc_id, i.item_id, i.n_shingles, count(*) AS n_shared
             FROM d JOIN i ON d.s = i.s GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM hit WHERE n_shared >= ceil(n_shingles * {MIN_SIMILARITY} - 1e-9)
"""
