"""Corpus cleaning pipeline: toxicity, line dedup, near-dedup, decontamination,
packing.

Each stage takes (spark, docs, sf_dir) and works on every row that its
predecessor kept; ``run`` applies them to the documents table, each result
stored as Parquet below ``spark.checkpoint.dir`` and read again.

Defined results: null and empty texts pass the toxicity stage unless the model
says otherwise for texts without evidence, and equal empty texts count as one
group of copies; rows without a doc_id pass near-dedup; extra columns are kept
until packing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.llm import decontaminate, line_dedup, order_minhash, packing, toxicity
from shiplog.llm.common import freeze, read_table, share_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under one half."""
    share_package(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    clean = line_dedup.drop_boilerplate(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(length, "n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    share_package(spark)
    return order_minhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    share_package(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: The trained and tokenising stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
