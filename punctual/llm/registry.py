"""Registered queries of the operators in this folder, and their SQL.

A query applies its operator with production parameters to its whole table and derives
the registered columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import (
    alignment, binary_codes, lines, lm, minhash, mixing, packing, pii, projections, quality,
    search, secret_scan, sql, toxicity,
)
from punctual.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.with_surrogates(_table(spark, folder, "documents")).select(
        "doc_id", "text", "n_entities", "kinds"
    )


def op2_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(_table(spark, folder, "documents"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), size=3, percent=85)


def op4_binary_codes(spark: SparkSession, folder: str) -> DataFrame:
    return binary_codes.near_vectors(_table(spark, folder, "embeddings"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.selection(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op9_projections(spark: SparkSession, folder: str) -> DataFrame:
    return projections.nearest(
        _table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )


def op8_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.dedup_lines(_table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", "text"
    )


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The first scan of a new ledger, so every text of the table is read."""
    ledger = secret_scan.Ledger(spark, scratch_path(spark, "ledger"))
    return secret_scan.scan_documents(_table(spark, folder, "documents"), ledger).drop("blob")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(_table(spark, folder, "documents"))


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10
    )


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )


QUERIES: dict[str, Query] = {
    "op1_surrogates": op1_surrogates,
    "op2_lm": op2_lm,
    "op3_minhash": op3_minhash,
    "op4_binary_codes": op4_binary_codes,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_lines": op8_lines,
    "op9_projections": op9_projections,
    "op10_secrets": op10_secrets,
    "op11_alignment": op11_alignment,
    "op12_search": op12_search,
    "op13_toxicity": op13_toxicity,
}

SQL: dict[str, str] = sql.STATEMENTS
