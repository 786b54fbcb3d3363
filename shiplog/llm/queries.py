"""Registered queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplog.llm import cover_tree, decontaminate, gru_lm, hard_negatives, html_extract, line_dedup, order_minhash, packing, secret_scan, segment_simhash, suffix_dedup, token_alignment, toxicity
from shiplog.llm.common import read_table, share_package


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    found = suffix_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return cover_tree.top_k(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return order_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return gru_lm.score(read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return token_alignment.alignment_report(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return hard_negatives.hard_negatives(
        read_table(spark, sf_dir, "embeddings"),
        lambda vec_id: vec_id % 50 == 0,
        lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label),
    )


def op13_segment_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    return segment_simhash.simhash_classes(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_cover_tree": op2_cover_tree,
    "op3_decontaminate": op3_decontaminate,
    "op4_order_minhash": op4_order_minhash,
    "op5_gru_lm": op5_gru_lm,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_html_extract": op10_html_extract,
    "op11_token_alignment": op11_token_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_segment_simhash": op13_segment_simhash,
}

ORACLE: dict[str, str] = {
    "op2_cover_tree": cover_tree.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
